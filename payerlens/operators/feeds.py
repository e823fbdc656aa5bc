"""Chart-ready tables. Each takes a stored or freshly computed aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payerlens.functions import millions_label, percent_label
from payerlens.schemas import MONTH


def monthly_spend_pivot(
    spend: DataFrame, plan_types: Sequence[str] | None = None
) -> DataFrame:
    """One line per plan: months down, plans across, NULL where a plan had no claim.

    Every plan of the input gets a column, so the columns of a month sum up to the month.
    Spark looks for the plans itself: pass a stored aggregate. Naming ``plan_types`` saves
    that job where no other plan can occur.
    """
    values = None if plan_types is None else list(plan_types)
    return spend.groupBy(MONTH).pivot("plan_type", values).sum("total_paid")


def outlier_scatter(outliers: DataFrame) -> DataFrame:
    label = F.when(F.col("is_cost_outlier"), "outlier").otherwise("normal")
    return outliers.select(
        "provider_id",
        "claim_count",
        "avg_billed",
        label.alias("outlier_class"),
        "outlier_threshold",
    )


def diagnosis_bars(costs: DataFrame) -> DataFrame:
    return costs.select(
        "diagnosis_category", "total_paid", millions_label(F.col("total_paid")).alias("label")
    )


def denial_rate_bars(denials: DataFrame) -> DataFrame:
    return denials.select(
        "provider_type", "denial_rate", percent_label(F.col("denial_rate")).alias("label")
    )


def readmission_bars(rates: DataFrame) -> DataFrame:
    return rates.select(
        "diagnosis_category",
        "readmission_rate",
        percent_label(F.col("readmission_rate")).alias("label"),
    )
