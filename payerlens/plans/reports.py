"""The reports over the curated fact and the order in which they are presented.

Operators return unsorted results: a sort before a write costs a range shuffle
that no reader may rely on. Sorting belongs to presentation, here.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payerlens.operators import denials, feeds, members, providers, spend
from payerlens.operators.summary import of_summary
from payerlens.schemas import MONTH


class Report(NamedTuple):
    build: Callable[[DataFrame], DataFrame]
    # Column names; a leading minus sorts in descending order. A report that
    # ends in a top-k is sorted already and names none.
    order: tuple[str, ...]

    def sort_columns(self) -> list[Column]:
        return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in self.order]

    def run(self, source: DataFrame) -> DataFrame:
        result = self.build(source)
        return result.orderBy(*self.sort_columns()) if self.order else result


# Reports over the curated fact; those in FROM_PROFILE take a provider profile.
# Keys behind a measure make its ties stable.
REPORTS: dict[str, Report] = {
    "monthly_spend": Report(spend.monthly_spend, (MONTH, "plan_type")),
    "diagnosis_cost": Report(
        spend.diagnosis_cost, ("-total_paid", "diagnosis_category")
    ),
    "denial_by_provider_type": Report(
        denials.denial_by_provider_type, ("-denial_rate", "provider_type")
    ),
    "denial_by_reason": Report(
        denials.denial_by_reason, ("-denied_claims", "denial_reason")
    ),
    "provider_outliers": Report(
        providers.provider_outliers, ("-avg_billed", "provider_id", "provider_type")
    ),
    "readmissions": Report(
        members.readmissions, ("-readmission_rate", "diagnosis_category")
    ),
    "pmpm": Report(spend.pmpm, (MONTH, "plan_type")),
    "mom_trend": Report(spend.mom_trend, (MONTH,)),
    "submission_lag": Report(
        providers.submission_lag, ("-avg_days_to_submit", "provider_type")
    ),
    "high_utilizers": Report(members.high_utilizers, ()),
    "denial_trend": Report(denials.denial_trend, (MONTH,)),
    "top_providers": Report(
        lambda profile: providers.top_providers(profile, providers.provider_outliers(profile)),
        ("-total_paid", "provider_id", "provider_type"),
    ),
    "age_diagnosis_cost": Report(
        spend.age_diagnosis_cost,
        ("member_age_band", "-total_paid", "diagnosis_category"),
    ),
}

FROM_PROFILE = {"provider_outliers", "top_providers"}

# Stored aggregate table -> report that fills it.
AGGREGATES = {
    "agg_monthly_spend": "monthly_spend",
    "agg_diagnosis_cost": "diagnosis_cost",
    "agg_denial_by_provider_type": "denial_by_provider_type",
    "agg_denial_by_reason": "denial_by_reason",
    "agg_provider_outliers": "provider_outliers",
    "agg_readmissions": "readmissions",
}

# Reports that a stored summary of the claims answers as well as the claims do.
FROM_SUMMARY = {
    "diagnosis_cost": partial(spend.diagnosis_cost, totals=of_summary),
    "denial_by_provider_type": partial(denials.denial_by_provider_type, totals=of_summary),
    "denial_by_reason": partial(denials.denial_by_reason, totals=of_summary),
    "readmissions": partial(members.readmissions, totals=of_summary),
}

# Chart feed -> (aggregate report it reads, how it is derived and sorted).
FEEDS: dict[str, tuple[str, Report]] = {
    "monthly_spend_pivot": ("monthly_spend", Report(feeds.monthly_spend_pivot, (MONTH,))),
    "outlier_scatter": (
        "provider_outliers",
        Report(feeds.outlier_scatter, ("-avg_billed", "provider_id")),
    ),
    "diagnosis_bars": (
        "diagnosis_cost",
        Report(feeds.diagnosis_bars, ("total_paid", "diagnosis_category")),
    ),
    "denial_rate_bars": (
        "denial_by_provider_type",
        Report(feeds.denial_rate_bars, ("denial_rate", "provider_type")),
    ),
    "readmission_bars": (
        "readmissions",
        Report(feeds.readmission_bars, ("readmission_rate", "diagnosis_category")),
    ),
}

