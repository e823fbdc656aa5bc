"""Session set-up. The master is never set here: spark-submit or the caller decides it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Dates are grouped by calendar month, so every job runs in one fixed zone. The
# adaptive settings are Spark's defaults, named because the writers and the
# skewed joins depend on them.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(
    app_name: str = "payerlens",
    extra: Mapping[str, str] | None = None,
    master: str | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
