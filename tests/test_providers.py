from datetime import date

import pytest
from conftest import TABLES, by, plan_of, rows

from payerlens.operators.cleaning import clean
from payerlens.operators.feeds import outlier_scatter
from payerlens.operators.providers import (
    provider_outliers,
    provider_profile,
    submission_lag,
    top_providers,
)
from payerlens.sources.order_feed import claims_feed


def test_one_provider_has_its_mean_as_threshold(claims):
    row = rows(provider_outliers(provider_profile(claims({}, {"billed_amount": "50"}))))[0]
    assert row["avg_billed"] == row["outlier_threshold"] == row["cohort_mean_avg_billed"] == 75.0
    assert row["is_cost_outlier"] is False
    assert row["claim_count"] == 2 and row["total_billed"] == 150.0


def test_cohort_statistics_use_rounded_averages_and_sample_deviation(claims):
    averages = [10.0, 20.0, 60.0]
    frame = claims(*[{"provider_id": f"p{n}", "billed_amount": a} for n, a in enumerate(averages)])
    mean = sum(averages) / 3
    deviation = (sum((a - mean) ** 2 for a in averages) / 2) ** 0.5
    for z in (1.0, 2.0):
        got = by(provider_outliers(provider_profile(frame), z), "provider_id")
        assert got["p0"]["outlier_threshold"] == pytest.approx(round(mean + z * deviation, 2))
        assert got["p2"]["is_cost_outlier"] is (60.0 > mean + z * deviation)
        assert len(got) == 3


def test_seeded_outliers_are_exactly_the_flagged_ones(spark):
    profile = provider_profile(clean(claims_feed(spark, TABLES)))
    got = rows(provider_outliers(profile))
    flagged = {r["provider_id"] for r in got if r["is_cost_outlier"]}
    assert flagged == {r["provider_id"] for r in got if int(r["provider_id"][4:]) % 33 == 7}
    assert flagged


def test_no_cross_join_and_no_driver_loop_in_the_plan(claims):
    plan = plan_of(provider_outliers(provider_profile(claims({}))))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def top(frame):
    profile = provider_profile(frame)
    return top_providers(profile, provider_outliers(profile))


def test_provider_with_two_types_does_not_fan_out(claims):
    frame = claims({"provider_type": "lab", "paid_amount": "10"},
                   {"provider_type": "hospital", "paid_amount": "5"})
    assert sorted((r["provider_type"], r["total_paid"]) for r in rows(top(frame))) == [
        ("hospital", 5.0), ("lab", 10.0)]


def test_flag_lookup_matches_a_missing_type_and_keeps_unknown_providers(claims):
    frame = claims({"provider_type": None}, {"provider_id": "new"})
    outliers = provider_outliers(provider_profile(frame.where("provider_id = 'p1'")))
    got = by(top_providers(provider_profile(frame), outliers), "provider_id")
    assert got["p1"]["is_cost_outlier"] is False
    assert got["new"]["is_cost_outlier"] is None


def test_tenth_place_tie_is_decided_by_the_key(claims):
    frame = claims(*[{"provider_id": f"p{n:02}", "paid_amount": 100 - min(n, 9)}
                     for n in range(12)])
    assert sorted(r["provider_id"] for r in rows(top(frame))) == [f"p{n:02}" for n in range(10)]


def test_fact_is_reduced_before_the_flags_are_joined(claims):
    plan = plan_of(top(claims({})))
    assert plan.index("LeftOuter") < plan.index("TakeOrderedAndProject(limit=10")


def test_scatter_labels(claims):
    frame = claims(*[{"provider_id": f"p{n}", "billed_amount": "10"} for n in range(9)],
                   {"provider_id": "high", "billed_amount": "1000"})
    got = by(outlier_scatter(provider_outliers(provider_profile(frame))), "provider_id")
    assert got["high"]["outlier_class"] == "outlier" and got["p0"]["outlier_class"] == "normal"


def test_submission_lag(claims):
    day = date(2026, 1, 1)
    got = rows(submission_lag(claims(
        {"service_date": day, "submission_date": date(2026, 1, 2)},
        {"service_date": day, "submission_date": date(2026, 1, 3)},
        {"service_date": day, "submission_date": None},
    )))[0]
    assert got == {"provider_type": "lab", "avg_days_to_submit": 1.5, "claim_count": 3}
