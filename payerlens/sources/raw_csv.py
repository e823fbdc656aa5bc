"""The raw claims feed: headered CSV, one row per claim."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from payerlens.schemas import RAW_COLUMNS


def load_raw(spark: SparkSession, path: str) -> DataFrame:
    """The 18 raw columns as text; parsing is left to ``parse``.

    Only the header is read ahead, there is no inference pass. CSV binds a
    schema by position, so the schema follows the order of the header and the
    columns are then picked by name; extra columns are tolerated. With
    ``enforceSchema`` off, Spark fails when another file of the directory has
    its columns in a different order instead of misreading it.
    """
    header = spark.read.option("header", True).csv(path).columns
    missing = [c for c in RAW_COLUMNS if c not in header]
    if missing:
        raise ValueError(f"raw feed {path} lacks columns: {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
        .select(*RAW_COLUMNS)
    )
