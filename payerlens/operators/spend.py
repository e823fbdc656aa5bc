"""Cost metrics: spend by month and plan, diagnosis burden, PMPM, trend."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payerlens.functions import dollars, exact_ratio
from payerlens.operators.summary import Totals, of_claims
from payerlens.schemas import MONTH


def monthly_spend(claims: DataFrame) -> DataFrame:
    return claims.groupBy(MONTH, "plan_type").agg(
        dollars(F.sum("paid_amount")).alias("total_paid"),
        dollars(F.sum("billed_amount")).alias("total_billed"),
        F.count("*").alias("claim_count"),
        F.count_distinct("member_id").alias("distinct_members"),
    )


def diagnosis_cost(claims: DataFrame, totals: Callable[[], Totals] = of_claims) -> DataFrame:
    group = totals()
    return claims.groupBy("diagnosis_category").agg(
        dollars(group.paid).alias("total_paid"),
        exact_ratio(group.paid, group.paid_claims, 2).alias("avg_paid_per_claim"),
        group.claims.alias("claim_count"),
    )


def pmpm(claims: DataFrame) -> DataFrame:
    """Paid per member per month, over members with a claim in that month."""
    ratio = exact_ratio(F.sum("paid_amount"), F.count_distinct("member_id"), 2)
    return claims.groupBy(MONTH, "plan_type").agg(ratio.alias("pmpm"))


def age_diagnosis_cost(claims: DataFrame) -> DataFrame:
    return claims.groupBy("member_age_band", "diagnosis_category").agg(
        dollars(F.sum("paid_amount")).alias("total_paid"),
        F.count("*").alias("claim_count"),
    )


def mom_trend(claims: DataFrame) -> DataFrame:
    """Month-over-month change of total paid; a missing month is skipped.

    The window has no partition key on purpose. It sits above the monthly
    aggregate, so its single task sees one row per calendar month whatever the
    size of the fact.
    """
    monthly = claims.groupBy(MONTH).agg(
        F.sum("paid_amount").cast("decimal(20,2)").alias("paid")
    )
    previous = F.lag("paid").over(Window.orderBy(MONTH))
    change = F.col("paid") - F.col("previous")
    # decimal(20,2) operands leave 13 fractional digits in the quotient.
    percent = F.round(F.try_divide(change * F.lit(100), F.col("previous")), 2)
    return monthly.withColumn("previous", previous).select(
        MONTH,
        dollars(F.col("paid")).alias("total_paid"),
        dollars(change).alias("mom_change"),
        percent.cast("double").alias("mom_pct_change"),
    )
