from datetime import date

from conftest import by, rows

from payerlens.operators.feeds import diagnosis_bars, monthly_spend_pivot
from payerlens.operators.spend import (
    age_diagnosis_cost,
    diagnosis_cost,
    mom_trend,
    monthly_spend,
    pmpm,
)

JAN, FEB, APR, MAY = (date(2026, m, 3) for m in (1, 2, 4, 5))


def test_monthly_spend(claims):
    frame = monthly_spend(claims(
        {"member_id": "a", "paid_amount": "0.10", "billed_amount": "1"},
        {"member_id": "a", "paid_amount": "0.20", "billed_amount": "2"},
        {"member_id": "b", "paid_amount": "0.30", "billed_amount": "3"},
    ))
    assert rows(frame) == [{
        "service_month": "2026-01", "plan_type": "HMO", "total_paid": 0.6,
        "total_billed": 6.0, "claim_count": 3, "distinct_members": 2,
    }]


def test_diagnosis_average_ignores_missing_payments(claims):
    row = rows(diagnosis_cost(claims({"paid_amount": "10"}, {"paid_amount": None})))[0]
    assert (row["total_paid"], row["avg_paid_per_claim"], row["claim_count"]) == (10.0, 10.0, 2)


def test_average_of_nothing_is_null(claims):
    row = rows(diagnosis_cost(claims({"paid_amount": None})))[0]
    assert row["total_paid"] is None and row["avg_paid_per_claim"] is None


def test_average_is_rounded_once(claims):
    """1/7000 below the tie: rounding at six digits first would lift it."""
    paid = [{"paid_amount": "0.00"}] * 3 + [{"paid_amount": "0.01"}] * 4
    assert rows(diagnosis_cost(claims(*paid)))[0]["avg_paid_per_claim"] == 0.01
    paid = [{"paid_amount": "0.00"}] * 4 + [{"paid_amount": "0.01"}] * 3
    assert rows(diagnosis_cost(claims(*paid)))[0]["avg_paid_per_claim"] == 0.0


def test_pmpm_rounds_the_decimal_tie_up(claims):
    frame = claims({"member_id": "a", "paid_amount": "83491.01"}, {"member_id": "b",
                                                                   "paid_amount": "0"})
    assert rows(pmpm(frame))[0]["pmpm"] == 41745.51


def test_trend_skips_missing_months_and_survives_a_zero_month(claims):
    frame = mom_trend(claims(
        {"service_date": JAN, "paid_amount": "300"},
        {"service_date": FEB, "paid_amount": "0"},
        {"service_date": APR, "paid_amount": "80"},
        {"service_date": MAY, "paid_amount": "60"},
    ))
    got = by(frame, "service_month")
    assert got["2026-01"]["mom_change"] is None and got["2026-01"]["mom_pct_change"] is None
    assert (got["2026-02"]["mom_change"], got["2026-02"]["mom_pct_change"]) == (-300.0, -100.0)
    assert (got["2026-04"]["mom_change"], got["2026-04"]["mom_pct_change"]) == (80.0, None)
    assert (got["2026-05"]["mom_change"], got["2026-05"]["mom_pct_change"]) == (-20.0, -25.0)


def test_age_by_diagnosis(claims):
    got = rows(age_diagnosis_cost(claims({}, {}, {"member_age_band": "80+"})))
    assert sorted((r["member_age_band"], r["claim_count"]) for r in got) == [
        ("18-34", 2), ("80+", 1)]


def test_pivot_has_null_for_an_absent_plan(claims):
    spend = monthly_spend(claims({"service_date": JAN}, {"service_date": FEB, "plan_type": "PPO"}))
    got = by(monthly_spend_pivot(spend), "service_month")
    assert got["2026-01"]["HMO"] == 80.0 and got["2026-01"]["PPO"] is None
    assert set(got["2026-01"]) == {"service_month", "HMO", "PPO"}
    named = monthly_spend_pivot(spend, ["EPO", "HMO", "PPO"])
    assert named.columns == ["service_month", "EPO", "HMO", "PPO"]


def test_pivot_can_discover_plans(claims):
    spend = monthly_spend(claims({}, {"plan_type": "Indemnity"}))
    pivot = monthly_spend_pivot(spend)
    assert pivot.columns == ["service_month", "HMO", "Indemnity"]
    ((total,),), (row,) = spend.groupBy().sum("total_paid").collect(), pivot.collect()
    assert sum(row[1:]) == total


def test_millions_label(claims):
    costs = diagnosis_cost(claims({"paid_amount": "43249999.99"}))
    assert rows(diagnosis_bars(costs))[0]["label"] == "$43.2M"
