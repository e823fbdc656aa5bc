from datetime import date
from decimal import Decimal

from conftest import by, plan_of, rows

from payerlens.operators.cleaning import audit_rows, clean, keep_one_per_key
from payerlens.schemas import FACT_SCHEMA


def test_types_and_month(feed):
    frame = clean(feed({"is_readmission_within_30d": "True"}))
    assert frame.schema == FACT_SCHEMA or [
        (f.name, f.dataType) for f in frame.schema
    ] == [(f.name, f.dataType) for f in FACT_SCHEMA]
    row = rows(frame)[0]
    assert row["service_date"] == date(2026, 1, 15)
    assert row["service_month"] == "2026-01"
    assert row["billed_amount"] == Decimal("100.00")
    assert row["is_readmission_within_30d"] is True


def test_rejected_rows(feed):
    frame = feed(
        {"claim_id": None},
        {"claim_id": "a", "member_id": None},
        {"claim_id": "b", "service_date": None},
        {"claim_id": "c", "service_date": "2026-13-01"},
        {"claim_id": "d", "claim_status": "Denied"},
        {"claim_id": "e", "claim_status": "pending"},
        {"claim_id": "f", "claim_status": None},
        {"claim_id": "g", "billed_amount": "-0.001"},
        {"claim_id": "h", "billed_amount": "abc"},
        {"claim_id": "i", "billed_amount": None},
        {"claim_id": "j", "billed_amount": "NaN"},
        {"claim_id": "k", "billed_amount": "0"},
    )
    assert list(by(clean(frame), "claim_id")) == ["k"]
    assert rows(audit_rows(frame)) == [{"raw_rows": 12, "clean_rows": 1}]


def test_dirt_in_optional_fields_becomes_null(feed):
    row = rows(clean(feed({
        "allowed_amount": "abc", "paid_amount": "-5", "submission_date": "soon",
        "is_readmission_within_30d": "maybe",
    })))[0]
    assert row["allowed_amount"] is None
    assert row["paid_amount"] == Decimal("-5.00")
    assert row["submission_date"] is None
    assert row["is_readmission_within_30d"] is None


def test_dates_with_a_time_part(feed):
    row = rows(clean(feed({"service_date": "2026-01-31 23:59:59"})))[0]
    assert row["service_date"] == date(2026, 1, 31)


def test_deduplication_precedes_the_filters(feed):
    """If the surviving copy is invalid the claim is lost; the other copy is not a spare."""
    valid, invalid = {"claim_id": "a"}, {"claim_id": "a", "claim_status": "pending"}
    survivors = {clean(feed(*order)).count() for order in ([valid, invalid], [invalid, valid])}
    assert len(survivors) == 1
    copies = [{"claim_id": "x", "diagnosis_category": d} for d in "abcdefgh"]
    # Some of the many two-copy claims must lose to their invalid copy.
    many = [r | {"claim_id": str(n)} for n in range(64) for r in (valid, invalid)]
    kept = clean(feed(*many)).count()
    assert 0 < kept < 64
    assert rows(audit_rows(feed(*many))) == [{"raw_rows": 128, "clean_rows": kept}]
    assert clean(feed(*copies)).count() == 1


def test_survivor_does_not_depend_on_row_order_or_partitions(feed):
    copies = [{"claim_id": "x", "diagnosis_category": d} for d in "abcdefgh"]
    copies += [{"claim_id": "x", "allowed_amount": None, "paid_amount": "7"},
               {"claim_id": "x", "allowed_amount": "7", "paid_amount": None}]
    picks = {
        tuple(clean(feed(*order).repartition(n)).collect()[0])
        for order in (copies, copies[::-1])
        for n in (1, 3, 7)
    }
    assert len(picks) == 1


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A key with a third of the rows reaches the shuffle as one row per map task."""
    frame = spark.range(0, 30000, 1, 6).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k", "id AS v"
    )
    unique = keep_one_per_key(frame, "k")
    plan = plan_of(unique)
    assert plan.index("Exchange hashpartitioning(k") < plan.index("row_number(), 1, Partial")
    assert unique.count() == 20001


def test_audit_of_an_empty_feed(feed):
    assert rows(audit_rows(feed())) == [{"raw_rows": 0, "clean_rows": 0}]


def test_audit_needs_no_sort(feed):
    plan = plan_of(audit_rows(feed({})))
    assert "SortAggregate" not in plan and "Sort [" not in plan
