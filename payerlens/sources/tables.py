"""Curated tables on storage: the month-partitioned fact, the aggregates, their CSV copies."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from payerlens.operators.cleaning import REASONS, rule_counts
from payerlens.operators.narrow_rows import rebalanced
from payerlens.plans.workspace import shared_folder, store
from payerlens.schemas import AGGREGATE_DDL, FACT_COLUMNS, FACT_SCHEMA, MONTH, RAW_COLUMNS, WAREHOUSE_SCHEMA
from payerlens.sources.runs import run_folder, table_folder

FACT = "claims"


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def csv_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/_csv/{name}"


def write_fact(claims: DataFrame, base: str) -> None:
    """Overwrites the fact, partitioned by month.

    Rebalancing on the month brings each month's rows together, so a task does
    not open a file for every month; unlike ``repartition`` on the month it
    splits a large month over many tasks, each with one file of the advisory
    partition size. In the shuffle the text of a row is one value.
    """
    _write_months(rebalanced(claims, MONTH), base)


def _write_months(claims: DataFrame, base: str) -> None:
    claims.write.mode("overwrite").partitionBy(MONTH).parquet(table_path(base, FACT))


def write_audited_fact(survivors: DataFrame, base: str) -> dict[str, int]:
    """Writes the valid ones of ``survivors_with_reasons`` and returns the counts of ``rule_counts``.

    The counts are observed in the writing stage, above its last shuffle: Spark takes
    them once from each task of a job's last stage, so repeated and speculative tasks
    count once. The rejected rows go no further than that stage.
    """
    counts = Observation("rules")
    observed = rebalanced(survivors, MONTH).observe(counts, *rule_counts())
    _write_months(observed.where(F.col(REASONS) == 0).select(*FACT_COLUMNS), base)
    return counts.get


def read_fact(
    spark: SparkSession,
    base: str,
    first_month: str | None = None,
    last_month: str | None = None,
) -> DataFrame:
    """The fact of the current run, optionally for a range of months: other partitions are not read."""
    fact = spark.read.schema(FACT_SCHEMA).parquet(table_path(run_folder(spark, base), FACT))
    if first_month is not None:
        fact = fact.where(F.col(MONTH) >= first_month)
    if last_month is not None:
        fact = fact.where(F.col(MONTH) <= last_month)
    return fact


def write_fact_csv(spark: SparkSession, base: str) -> None:
    """CSV copy of the stored fact in as many parts as the scan has, months included."""
    (
        read_fact(spark, base)
        .write.mode("overwrite")
        .option("header", True)
        .csv(csv_path(base, FACT))
    )


def write_aggregate(aggregate: DataFrame, base: str, name: str) -> None:
    """Overwrites one aggregate table and its CSV copy.

    Rebalancing gives one file while the table is small and more when it is not:
    the provider table grows with the number of providers. The CSV copy comes
    from the stored table, so both always agree.
    """
    path = table_path(base, name)
    aggregate.hint("rebalance").write.mode("overwrite").parquet(path)
    (
        read_aggregate(aggregate.sparkSession, base, name)
        .hint("rebalance")
        .write.mode("overwrite")
        .option("header", True)
        .csv(csv_path(base, name))
    )


def read_aggregate(spark: SparkSession, base: str, name: str) -> DataFrame:
    folder = run_folder(spark, base)
    return spark.read.schema(AGGREGATE_DDL[name]).parquet(table_path(folder, name))


def read_aggregate_csv(spark: SparkSession, base: str, name: str) -> DataFrame:
    """All parts of an aggregate's CSV copy; an error if there is none."""
    path = csv_path(run_folder(spark, base), name)
    # The schema is given: inference would turn the month into a timestamp.
    try:
        copy = spark.read.schema(AGGREGATE_DDL[name]).option("header", True).csv(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no CSV copy of {name} under {path}") from missing
    if not copy.inputFiles():
        raise FileNotFoundError(f"no CSV copy of {name} under {path}")
    return copy


def read_fact_by_path(spark: SparkSession, path: str) -> DataFrame:
    """Reads staged claim files, month taken from the path, fields cast to the warehouse types.

    The month is the directory of a file, ``service_month=2026-01`` or ``2026-01``; a file
    outside such a directory gets NULL. Files of equal name in different months cannot
    collide because the full path identifies them. Each file is read with its own types, so
    files that hold money as double, text or decimal load together, in one directory
    or in many; fields are cast by name, a value that cannot be cast and a column that is
    absent give NULL, and other columns are ignored.

    Footers are read in tasks. Files of equal schema are one scan, and where all
    agree that scan is of ``path`` itself; only then do no file names reach the driver
    beyond those that Spark lists for a scan anyway. A path of a curated table is that of
    the current run.
    """
    path = table_folder(spark, path)
    schemas = file_schemas(spark, path)
    kinds = [r["file_schema"] for r in schemas.select("file_schema").distinct().collect()]
    if not kinds:
        return spark.createDataFrame([], WAREHOUSE_SCHEMA)
    if len(kinds) == 1:
        return _staged(spark, [path])
    groups = schemas.groupBy("file_schema").agg(F.sort_array(F.collect_list("path")).alias("files"))
    return reduce(DataFrame.unionByName, [_staged(spark, r["files"]) for r in groups.sort("file_schema").collect()])


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """(path, file_schema) of every Parquet file below ``path``, from its footer, stored.

    ``file_schema`` is text that two files share if their columns agree in name, order and types.
    """
    kinds = "path string, file_schema string"
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet").load(path)
    )
    purpose = "staged-schemas"
    found = store(files.select("path").mapInArrow(_footers, kinds), shared_folder(spark, purpose))
    if found.where("file_schema IS NULL").isEmpty():
        return found
    # A store that only Spark reaches: a task loads one file after the other and cuts off its footer.
    end = F.length("content")
    size = F.hex(F.substring("content", end - 7, F.lit(4)))
    turned = F.concat(*[F.substring(size, at, 2) for at in (7, 5, 3, 1)])
    footer = F.substring("content", end - 7 - F.conv(turned, 16, 10).cast("int"), end)
    return store(files.select("path", footer.alias("footer")).mapInArrow(_cut_footers, kinds), shared_folder(spark, purpose))


def _schema_text(file) -> str:
    schema = pq.ParquetFile(file).schema
    columns = [schema.column(i) for i in range(len(schema))]
    return repr([(c.path, c.physical_type, str(c.logical_type), c.max_definition_level) for c in columns])


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Schemas by pyarrow's file systems; null where they do not know the store."""
    for batch in batches:
        paths, found = batch.column("path").to_pylist(), []
        for path in paths:
            try:
                files, inner = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", unquote(path)))
            except (pa.ArrowInvalid, OSError):
                found.append(None)
                continue
            with files.open_input_file(inner) as file:
                found.append(_schema_text(file))
        yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(found, pa.string())], ["path", "file_schema"])


def _cut_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_schema_text(pa.BufferReader(b"PAR1" + footer)) for footer in batch.column("footer").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string())], ["path", "file_schema"])


def _staged(spark: SparkSession, paths: list[str]) -> DataFrame:
    month = F.regexp_extract(
        F.col("_metadata.file_path"), rf"/(?:{MONTH}=)?([0-9]{{4}}-[0-9]{{2}})/[^/]*$", 1
    )
    staged = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(*paths)
    fields = [
        (F.col(f.name).try_cast(f.dataType) if f.name in staged.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in WAREHOUSE_SCHEMA[: len(RAW_COLUMNS)]
    ]
    return staged.select(*fields, F.nullif(month, F.lit("")).alias(MONTH))
