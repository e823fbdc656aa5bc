"""Denial rates and reasons. The status comparison is case-sensitive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from payerlens.functions import dollars, exact_ratio
from payerlens.operators.summary import Totals, is_denied, of_claims
from payerlens.schemas import MONTH


def _denial_rate(claims: DataFrame, key: str, totals: Totals) -> DataFrame:
    return claims.groupBy(key).agg(
        totals.claims.alias("total_claims"),
        totals.denied.alias("denied_claims"),
        exact_ratio(totals.denied, totals.claims, 4).alias("denial_rate"),
    )


def denial_by_provider_type(
    claims: DataFrame, totals: Callable[[], Totals] = of_claims
) -> DataFrame:
    """One conditional aggregation; a type without denials shows 0 and 0.0."""
    return _denial_rate(claims, "provider_type", totals())


def denial_trend(claims: DataFrame) -> DataFrame:
    return _denial_rate(claims, MONTH, of_claims())


def denial_by_reason(claims: DataFrame, totals: Callable[[], Totals] = of_claims) -> DataFrame:
    """Denied claims only; a missing reason is a group of its own."""
    group = totals()
    return (
        claims.where(is_denied())
        .groupBy("denial_reason")
        .agg(
            group.claims.alias("denied_claims"),
            dollars(group.billed).alias("billed_amount_denied"),
        )
    )
