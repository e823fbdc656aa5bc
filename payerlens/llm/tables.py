"""Small helpers of the operators: input columns, stored tables, bounded samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payerlens.plans.workspace import shared_folder, store


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: the lineage ends there."""
    return store(df, shared_folder(df.sparkSession, purpose))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names, so no other can clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def hash_share(key, rate) -> F.Column:
    """True for about ``rate`` of all keys, always for the same ones."""
    return F.pmod(F.xxhash64(key), F.lit(1_000_000)) < F.ceil(F.lit(1_000_000) * rate)
