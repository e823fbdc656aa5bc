"""Catalog tables over the curated files, and the warehouse copy of the fact."""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from payerlens.schemas import AGGREGATE_DDL, FACT_SCHEMA, MONTH, columns_ddl
from payerlens.sources.runs import current_run, run_folder
from payerlens.sources.tables import FACT, read_fact_by_path, table_path

DATABASE = "claims_warehouse"


def _location(path: str) -> str:
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    return f"LOCATION '{quoted}'"


def _bare(location: str) -> str:
    """A location without the scheme of local files and without a last slash."""
    return re.sub("^file:/*(?=/)", "", location).rstrip("/")


def _refuse_managed(spark: SparkSession, name: str) -> None:
    if spark.catalog.getTable(name).tableType != "EXTERNAL":
        raise ValueError(f"{name} is a managed table; it is not replaced")


def _register(spark: SparkSession, name: str, ddl: str, path: str, partitioned: str = "") -> None:
    """An external table over ``path``. One that points elsewhere or has other columns is replaced.

    Dropping an external table leaves its files. A managed table of that name is refused.
    """
    if spark.catalog.tableExists(name):
        described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        _refuse_managed(spark, name)
        wanted = spark.createDataFrame([], ddl)
        same = [(f.name, f.dataType) for f in spark.table(name).schema] == [
            (f.name, f.dataType) for f in wanted.schema
        ]
        if not same or _bare(described["Location"]) != _bare(path):
            spark.sql(f"DROP TABLE {name}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING PARQUET {partitioned} {_location(path)}"
    )


def register_curated(spark: SparkSession, base: str, database: str = DATABASE) -> None:
    """External tables for the fact and the six aggregates, as they are under ``base`` now.

    Run it after every pipeline run: months that came or went are recovered or dropped,
    cached file lists are refreshed, and tables registered over another base or with
    other columns are replaced. While a table is replaced a reader can miss it;
    ``publish_views`` has no such moment.
    """
    base = run_folder(spark, base)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    fact = f"{database}.{FACT}"
    _register(spark, fact, columns_ddl(FACT_SCHEMA), table_path(base, FACT), f"PARTITIONED BY ({MONTH})")
    spark.sql(f"MSCK REPAIR TABLE {fact} SYNC PARTITIONS")
    for name, ddl in AGGREGATE_DDL.items():
        _register(spark, f"{database}.{name}", ddl, table_path(base, name))
    for name in (FACT, *AGGREGATE_DDL):
        spark.sql(f"REFRESH TABLE {database}.{name}")


def publish_views(spark: SparkSession, base: str, database: str = DATABASE) -> str:
    """Views of ``database`` over the current run's tables; returns the run's id.

    The tables of a run are external tables of ``<database>_runs`` under names of their own.
    A view that exists is altered in one catalog statement, so its name always resolves, to
    the old run or to the new one. The seven views follow one another; a reader that needs
    all tables of one run takes them from its folder (``run_folder``). An external table
    in a view's place, from ``register_curated``, is dropped for it once; a managed one is refused.
    """
    run = current_run(spark, base)
    if run is None:
        raise ValueError(f"no run is committed under {base}")
    below = f"{database}_runs"
    for name in (database, below):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    ddl = {FACT: columns_ddl(FACT_SCHEMA)} | AGGREGATE_DDL
    for name, columns in ddl.items():
        table = f"{below}.{name}__{run.run_id}"
        months = f"PARTITIONED BY ({MONTH})" if name == FACT else ""
        _register(spark, table, columns, table_path(run.folder, name), months)
        if months:
            spark.sql(f"MSCK REPAIR TABLE {table}")
    for name in ddl:
        view, select = f"{database}.{name}", f"SELECT * FROM {below}.{name}__{run.run_id}"
        if not spark.catalog.tableExists(view):
            spark.sql(f"CREATE VIEW {view} AS {select}")
        elif spark.catalog.getTable(view).tableType == "VIEW":
            spark.sql(f"ALTER VIEW {view} AS {select}")
        else:
            _refuse_managed(spark, view)
            spark.sql(f"DROP TABLE {view}")
            spark.sql(f"CREATE VIEW {view} AS {select}")
    return run.run_id


def forget_runs(spark: SparkSession, run_ids: list[str], database: str = DATABASE) -> None:
    """Drops the catalog tables of expired runs; no view refers to them any more."""
    below = f"{database}_runs"
    if not spark.catalog.databaseExists(below):
        return
    for table in spark.catalog.listTables(below):
        if table.name.rpartition("__")[2] in run_ids:
            spark.sql(f"DROP TABLE IF EXISTS {below}.{table.name}")


def list_tables(spark: SparkSession, database: str = DATABASE) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def load_warehouse(
    spark: SparkSession, fact_path: str, table: str = "warehouse.claims"
) -> DataFrame:
    """Full reload of the unpartitioned warehouse table from the fact's files.

    The files are loaded into a table beside it, whose rows are compared with the staged
    ones in number; then the two change names and the old one is dropped. A load that fails,
    or that lost rows, leaves the old table as it was and nothing beside it.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rpartition('.')[0] or 'default'}")
    mark = uuid4().hex[:8]
    beside, before = f"{table}__loading_{mark}", f"{table}__before_{mark}"
    staged = read_fact_by_path(spark, fact_path)
    try:
        staged.write.format("parquet").saveAsTable(beside)
        wanted, loaded = staged.count(), spark.table(beside).count()
        if wanted != loaded:
            raise RuntimeError(f"{fact_path} has {wanted} rows, {loaded} of them were loaded")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
        raise
    replaced = spark.catalog.tableExists(table)
    if replaced:
        spark.sql(f"ALTER TABLE {table} RENAME TO {before}")
    try:
        spark.sql(f"ALTER TABLE {beside} RENAME TO {table}")
    except Exception:
        if replaced:
            spark.sql(f"ALTER TABLE {before} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {before}")
    return spark.table(table)
