"""Exact moments, member sets, the two-phase de-duplication, the audit by rule, reconciliation of many sides."""

import random
from datetime import date

import pytest
from conftest import TABLES, by, plan_of, rows
from pyspark.sql import functions as F

from payerlens.operators.cleaning import (
    audit_by_rule,
    clean,
    clean_repeats,
    repeated_keys,
    survivors_with_reasons,
)
from payerlens.operators.member_sets import (
    member_sets,
    members_of_range,
    monthly_totals,
    number_members,
    pmpm_from_sets,
    rolling_members,
    spend_from_sets,
)
from payerlens.operators.providers import (
    add_moments,
    cohort_moments,
    deviation_of_moments,
    mean_of_moments,
    provider_outliers,
)
from payerlens.operators.reconcile import differing_leaves, range_digests, reconcile_sides, row_differences
from payerlens.operators.spend import monthly_spend, pmpm
from payerlens.plans.queries import two_phase_claims
from payerlens.sources.order_feed import claims_feed


def profile(spark, averages, parts=1):
    values = [(f"p{i}", "lab", float(a), 1, 0.0, 0.0) for i, a in enumerate(averages)]
    schema = "provider_id string, provider_type string, avg_billed double, claim_count bigint, total_billed double, total_paid double"
    return spark.createDataFrame(values, schema).repartition(parts)


def test_threshold_is_equal_to_the_last_bit_in_any_order(spark):
    draw = random.Random(3)
    averages = [round(draw.uniform(0.01, 1e7), 2) for _ in range(3000)]
    seen = set()
    for parts in (1, 3, 17):
        draw.shuffle(averages)
        cohort = cohort_moments(profile(spark, averages, parts)).select(mean_of_moments(), deviation_of_moments())
        seen.add(tuple(cohort.first()))
        seen.add(tuple(cohort.first()))
    ((mean, deviation),) = seen
    exact = sum(averages) / 3000
    assert mean == pytest.approx(exact)
    assert deviation == pytest.approx((sum((a - exact) ** 2 for a in averages) / 2999) ** 0.5)


def test_moments_of_parts_add_up(spark):
    whole = profile(spark, [1.5, 2.25, None or 9.99, 1e9])
    parts = cohort_moments(whole.where("avg_billed < 2")).unionByName(cohort_moments(whole.where("avg_billed >= 2")))
    assert rows(add_moments(parts)) == rows(cohort_moments(whole))
    assert rows(add_moments(cohort_moments(whole.limit(0)))) == [{"n": 0, "total": 0, "squares": 0}]


def test_small_spread_around_a_large_mean_is_exact(spark):
    averages = [9_999_999_999.99, 9_999_999_999.97] * 50
    deviation = cohort_moments(profile(spark, averages)).select(deviation_of_moments()).first()[0]
    assert deviation == pytest.approx(0.01 * (100 / 99) ** 0.5, rel=1e-12)


def test_flag_at_the_threshold_does_not_depend_on_partitions(spark):
    averages = [0.1 * (i % 7) + 1000 for i in range(500)]
    flags = {
        tuple(sorted((r["provider_id"], r["is_cost_outlier"]) for r in provider_outliers(profile(spark, averages, n), 1.0).collect()))
        for n in (1, 2, 9)
    }
    assert len(flags) == 1


@pytest.fixture(scope="module")
def months(claims):
    draw = random.Random(5)
    return claims(*[
        {"member_id": f"m{draw.randint(1, 60)}", "plan_type": draw.choice(["HMO", "PPO", None]), "claim_id": f"c{i}",
         "service_date": date(2025 + draw.randint(0, 1), draw.randint(1, 12), 3)} for i in range(600)
    ])


def test_sets_answer_what_the_fact_answers(spark, months):
    numbers = number_members(months)
    found = sorted(r["number"] for r in rows(numbers))
    assert found == list(range(len(found)))
    totals, sets = monthly_totals(months), member_sets(months, numbers)
    assert row_differences(spend_from_sets(totals, sets), monthly_spend(months)).count() == 0
    assert row_differences(pmpm_from_sets(totals, sets), pmpm(months)).count() == 0
    for first, last in (("2025-01", "2025-03"), ("2025-06", "2026-07"), ("2030-01", "2030-02")):
        direct = months.where(F.col("service_month").between(first, last)).groupBy("plan_type").agg(
            F.count_distinct("member_id").alias("distinct_members"))
        assert row_differences(members_of_range(sets, first, last), direct).count() == 0


def test_rolling_ranges(spark, months):
    sets = member_sets(months, number_members(months))
    members = {}
    for r in rows(months):
        year, month = map(int, r["service_month"].split("-"))
        members.setdefault((r["plan_type"], 12 * year + month - 1), set()).add(r["member_id"])
    expected = {
        (p, f"{m // 12}-{m % 12 + 1:02}"): len(set().union(*[members.get((p, m - k), set()) for k in range(3)]))
        for p, m in members
    }
    got = {(r["plan_type"], r["service_month"]): r["distinct_members"] for r in rows(rolling_members(sets))}
    assert got == expected


def test_new_members_get_the_next_numbers(spark, claims):
    first = number_members(claims({"member_id": "b"}, {"member_id": "a"}, {"member_id": None}))
    known = by(first, "member_id")
    both = by(number_members(claims({"member_id": "c"}, {"member_id": "a"}), first), "member_id")
    assert {m: r["number"] for m, r in both.items() if m in known} == {m: r["number"] for m, r in known.items()}
    assert both["c"]["number"] == 2


def test_two_phases_keep_the_same_survivors(spark, feed):
    copies = [{"claim_id": f"c{i % 40}", "paid_amount": f"{i}", "member_id": None if i % 11 == 0 else "m"} for i in range(90)]
    raw = feed(*copies, {"claim_id": None}, {"claim_id": "alone"})
    repeats = repeated_keys(raw, "claim_id")
    assert repeats.count() == 40
    for broadcast in (True, False):
        assert row_differences(clean(raw), clean_repeats(raw, repeats, broadcast)).count() == 0


def test_unique_claims_are_not_shuffled(spark):
    claims = two_phase_claims(claims_feed(spark, TABLES))
    plan = plan_of(claims)
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan
    assert row_differences(claims, clean(claims_feed(spark, TABLES))).count() == 0


def test_audit_and_written_survivors_agree(spark, feed):
    raw = feed(
        {"claim_id": "a"}, {"claim_id": "a"}, {"claim_id": None, "member_id": None}, {"claim_id": "b", "member_id": None},
        {"claim_id": "c", "claim_status": None, "service_date": "x"}, {"claim_id": "d", "billed_amount": "NaN"},
        {"claim_id": "e", "billed_amount": "-0.001"}, {"claim_id": "f", "billed_amount": "1e40"},
    )
    got = {r["rule"]: (r["raw_rows"], r["claims"], r["only_rule"]) for r in rows(audit_by_rule(raw))}
    assert got == {
        "claim_id_missing": (1, 0, 0), "member_id_missing": (2, 1, 1), "service_date_unreadable": (1, 1, 0),
        "claim_status_unknown": (1, 1, 0), "billed_amount_negative": (1, 1, 1), "billed_amount_unreadable": (2, 2, 2),
        None: (2, 1, 0),
    }
    survivors = survivors_with_reasons(raw)
    assert survivors.agg(F.sum("_copies")).first()[0] == 8
    valid = survivors.where("_reasons = 0").drop("_reasons", "_copies")
    assert row_differences(valid, clean(raw)).count() == 0
    empty = {r["rule"]: r["raw_rows"] for r in rows(audit_by_rule(raw.limit(0)))}
    assert len(empty) == 7 and not any(empty.values())


def test_survivor_is_the_same_by_both_routes(spark, feed):
    draw = random.Random(9)
    raw = feed(*[
        {"claim_id": f"c{draw.randint(0, 60)}", "paid_amount": str(draw.randint(0, 9)),
         "billed_amount": draw.choice(["5", "-1", "x"]), "member_id": draw.choice(["m", None])} for _ in range(500)
    ]).repartition(7)
    valid = survivors_with_reasons(raw).where("_reasons = 0").drop("_reasons", "_copies")
    assert row_differences(valid, clean(raw)).count() == 0


def side(spark, values):
    return spark.createDataFrame(values, "k string, v double")


def test_many_sides(spark):
    base = [(f"k{i}", float(i)) for i in range(500)] + [("twice", 1.0)] * 2 + [(None, None)]
    sides = {
        "a": side(spark, base),
        "b": side(spark, [x for x in base if x[0] != "k7"]).select("v", "k"),
        "c": side(spark, [(k, v if k != "k9" else -1.0) for k, v in base][:-2] + [(None, None)]),
    }
    got = by(reconcile_sides(sides, ["k"]), "side")
    assert {s: (r["total_rows"], r["agreeing_rows"], r["differing_rows"]) for s, r in got.items()} == {
        "a": (503, 499, 4), "b": (502, 499, 3), "c": (502, 499, 3)}
    assert all(r["compared_rows"] < 20 for r in got.values())
    leaves = differing_leaves(range_digests(sides, ["k"]), 3)
    assert 1 <= leaves.count() <= 3


def test_sides_that_agree_move_no_row(spark):
    base = side(spark, [("a", 1.0), ("a", 1.0), (None, 2.0)])
    got = rows(reconcile_sides({n: base for n in "wxyz"}, ["k"]))
    assert len(got) == 4 and all((r["total_rows"], r["compared_rows"], r["differing_rows"]) == (3, 0, 0) for r in got)
    empty = base.limit(0)
    assert [r["total_rows"] for r in rows(reconcile_sides({"a": empty, "b": empty}, ["k"]))] == [0, 0]
    with pytest.raises(ValueError, match="columns differ"):
        reconcile_sides({"a": base, "b": base.drop("v")}, ["k"])


def test_copies_do_not_cancel_out(spark):
    """An even number of equal rows on one side only is a difference."""
    left, right = side(spark, [("a", 1.0), ("b", 2.0), ("b", 2.0)]), side(spark, [("a", 1.0), ("c", 3.0), ("c", 3.0)])
    got = by(reconcile_sides({"l": left, "r": right}, ["k"]), "side")
    assert got["l"]["differing_rows"] == got["r"]["differing_rows"] == 2
