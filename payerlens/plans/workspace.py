"""Where a query keeps a table it writes and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_WAREHOUSE = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder that the cluster names.

    Every executor must see it. A session that names none uses a folder of its
    warehouse, which executors share as well; there is no machine-local fallback.
    """
    base = spark.conf.get(_SETTING, None) or f"{spark.conf.get(_WAREHOUSE).rstrip('/')}/_work"
    return f"{base.rstrip('/')}/payerlens/{purpose}-{uuid.uuid4().hex}"


def store(df: DataFrame, path: str) -> DataFrame:
    """Writes ``df`` as a table and returns the stored copy.

    For a result that is read more than once and expensive to compute: a lost
    executor then costs nothing that was already stored.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
