"""One pass over the claims for the aggregates whose totals add up."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payerlens.schemas import DENIED, FLAG

_KEYS = ["provider_type", "diagnosis_category", "claim_type", "claim_status", "denial_reason"]


def is_denied() -> Column:
    return F.col("claim_status") == DENIED


class Totals(NamedTuple):
    """The totals of a group, as aggregate expressions."""

    claims: Column
    denied: Column
    paid: Column
    paid_claims: Column
    billed: Column
    readmitted: Column


def of_claims() -> Totals:
    return Totals(
        claims=F.count("*"),
        denied=F.count_if(is_denied()),
        paid=F.sum("paid_amount"),
        paid_claims=F.count("paid_amount"),
        billed=F.sum("billed_amount"),
        readmitted=F.sum(F.col(FLAG).cast("int")),
    )


def of_summary() -> Totals:
    return Totals(
        claims=F.sum("claims"),
        denied=F.sum("denied"),
        paid=F.sum("paid"),
        paid_claims=F.sum("paid_claims"),
        billed=F.sum("billed"),
        readmitted=F.sum("readmitted"),
    )


def claim_summary(claims: DataFrame) -> DataFrame:
    """Totals by provider type, diagnosis, claim type, status and reason.

    Diagnosis cost, both denial tables and the readmission rate follow from it with
    ``of_summary``: counts and decimal sums add up exactly. Distinct members do not, and
    providers are too many to be a key here.
    """
    totals = of_claims()._asdict()
    return claims.groupBy(*_KEYS).agg(*[total.alias(name) for name, total in totals.items()])
