"""Commands over stored tables: the warehouse load and the analyst SQL on a database."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from payerlens.plans.analyst_sql import ANALYST_SQL
from payerlens.session import build_session
from payerlens.sources.catalog import DATABASE, load_warehouse
from payerlens.sources.tables import FACT, table_path


def query_database(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """Every analyst question on the catalog tables of ``database``."""
    names = {"claims": f"{database}.{FACT}", "outliers": f"{database}.agg_provider_outliers"}
    return {name: spark.sql(text.format(**names)) for name, text in ANALYST_SQL.items()}


def warehouse(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Reload the warehouse table from staged files.")
    parser.add_argument("--staged", required=True, help="directory of the staged Parquet files")
    parser.add_argument("--table", default="warehouse.claims")
    args = parser.parse_args(argv)
    loaded = load_warehouse(build_session("payerlens-warehouse"), args.staged, args.table)
    print(f"{args.table}: {loaded.count()} rows")


def analyst_sql(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run the analyst SQL on catalog tables.")
    parser.add_argument("--database", default=DATABASE)
    parser.add_argument("--out", required=True, help="each result is written here as a CSV table")
    args = parser.parse_args(argv)
    for name, result in query_database(build_session("payerlens-sql"), args.database).items():
        result.write.mode("overwrite").option("header", True).csv(table_path(args.out, name))
        print(name)
