"""Member-level metrics: high utilizers and 30-day inpatient readmissions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payerlens.functions import dollars, exact_ratio
from payerlens.operators.summary import Totals, of_claims
from payerlens.schemas import FLAG, INPATIENT, READMISSION_WINDOW_DAYS

_STAY = ["member_id", "service_date"]


def _is_inpatient() -> Column:
    return F.col("claim_type") == INPATIENT


def high_utilizers(claims: DataFrame, min_claims: int = 3, n: int = 25) -> DataFrame:
    """Members with at least ``min_claims`` inpatient claims, the n costliest."""
    return (
        claims.where(_is_inpatient())
        .groupBy("member_id")
        .agg(
            F.count("*").alias("inpatient_claim_count"),
            dollars(F.sum("paid_amount")).alias("total_paid"),
        )
        .where(F.col("inpatient_claim_count") >= min_claims)
        .orderBy(F.desc("total_paid"), "member_id")
        .limit(n)
    )


def readmissions(claims: DataFrame, totals: Callable[[], Totals] = of_claims) -> DataFrame:
    """Readmission rate by diagnosis; the denominator is inpatient claims only."""
    stays = totals()
    return (
        claims.where(_is_inpatient())
        .groupBy("diagnosis_category")
        .agg(
            stays.claims.alias("inpatient_claims"),
            stays.readmitted.alias("readmissions_30d"),
            exact_ratio(stays.readmitted, stays.claims, 4).alias("readmission_rate"),
        )
    )


def readmission_days(claims: DataFrame) -> DataFrame:
    """(member, day) pairs with an earlier inpatient day at most 30 days before.

    Whether such a day exists depends only on the distinct days of a member, and
    the nearest earlier day decides. The claims are therefore reduced to distinct
    days, with map-side combine, before the window: a member who holds a third
    of the claims still brings one row per calendar day.
    """
    days = claims.where(
        _is_inpatient() & F.col("member_id").isNotNull() & F.col("service_date").isNotNull()
    ).select(*_STAY).distinct()
    previous = F.lag("service_date").over(
        Window.partitionBy("member_id").orderBy("service_date")
    )
    return (
        days.withColumn("previous_day", previous)
        .where(F.date_diff("service_date", "previous_day") <= READMISSION_WINDOW_DAYS)
        .select(*_STAY)
    )


def flag_inpatient(inpatient: DataFrame, days: DataFrame) -> DataFrame:
    """Sets the readmission flag on inpatient claims by equi-join with ``days``.

    ``days`` is unique per pair, so the join cannot multiply rows; a member and
    day that holds very many claims is split by the adaptive skew join.
    """
    hits = days.withColumn("_hit", F.lit(True))
    return (
        inpatient.drop(FLAG)
        .join(hits, _STAY, "left")
        .withColumn(FLAG, F.coalesce("_hit", F.lit(False)))
        .drop("_hit")
    )


def with_readmission_flag(feed: DataFrame) -> DataFrame:
    """The whole feed with its readmission flag.

    Only inpatient claims of a known member can be readmissions, so only those
    go through the join; all others get False without being shuffled.
    """
    columns = [c for c in feed.columns if c != FLAG] + [FLAG]
    # A plain conjunction, so that each part of it is pushed to the scan that has its column.
    stays = (
        _is_inpatient() & F.col("member_id").isNotNull() & F.col("service_date").isNotNull()
    )
    flagged = flag_inpatient(feed.where(stays), readmission_days(feed))
    others = feed.where(~F.coalesce(stays, F.lit(False))).withColumn(FLAG, F.lit(False))
    return flagged.select(*columns).unionByName(others.select(*columns))
