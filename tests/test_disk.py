"""What the large queries shuffle: no more than the work needs, and the same rows as before."""

import hashlib
import random
from collections import Counter

import pytest
from conftest import TABLES, plan_of
from pyspark.sql import functions as F

from payerlens.operators.cleaning import clean, clean_repeats, repeated_keys, survivors_of_repeats, survivors_with_reasons
from payerlens.operators.key_bits import key_bits, with_bit
from payerlens.operators.narrow_rows import rebalanced
from payerlens.operators.reconcile import reconcile_sides, row_differences
from payerlens.plans import queries
from payerlens.plans.queries import QUERIES, two_phase_claims
from payerlens.schemas import MONTH
from payerlens.sources.order_feed import claims_feed, order_lines


@pytest.fixture
def no_small_tables(spark):
    """No table is small enough to be broadcast by its size, as on large inputs."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_bits_hold_exactly_the_given_hashes(spark):
    draw = random.Random(5)
    held = [draw.randrange(-(2**63), 2**63) for _ in range(3000)] + [0, -1, 2**63 - 1, -(2**63)]
    others = [draw.randrange(-(2**63), 2**63) for _ in range(3000)] + [1, 7, 8, 32767, 32768]
    bits = key_bits(spark.createDataFrame([(h,) for h in held], "h bigint"), "h")
    asked = spark.createDataFrame([(h,) for h in [*held, *others, None]], "h bigint")
    got = {r["h"]: r["found"] for r in with_bit(asked, "h", bits, "found").collect()}
    places = {h % 2**28 for h in held}
    assert got == {h: h is not None and h % 2**28 in places for h in [*held, *others, None]}
    empty = with_bit(asked, "h", key_bits(asked.limit(0), "h"), "found")
    assert empty.where("found").isEmpty() and empty.count() == len(held) + len(others) + 1


def test_many_repeats_shuffle_no_row_that_is_alone(spark, feed, no_small_tables):
    copies = [{"claim_id": f"c{i % 40}", "paid_amount": f"{i}", "member_id": None if i % 11 == 0 else "m"} for i in range(90)]
    raw = feed(*copies, {"claim_id": None}, *[{"claim_id": f"alone{i}"} for i in range(200)])
    claims = clean_repeats(raw, repeated_keys(raw, "claim_id"), broadcast=False)
    assert "SortMergeJoin" not in plan_of(claims)
    assert row_differences(claims, clean(raw)).count() == 0


def test_more_repeats_than_are_broadcast(spark):
    raw = claims_feed(spark, TABLES, with_flag=True)
    assert row_differences(two_phase_claims(raw, most_broadcast=0), clean(raw)).count() == 0


def test_stored_lines_give_the_same_feed(spark):
    lines = spark.createDataFrame(order_lines(spark, TABLES).collect(), order_lines(spark, TABLES).schema)
    for flag in (True, False):
        direct, stored = (claims_feed(spark, TABLES, flag, x) for x in (None, lines))
        assert row_differences(direct, stored).count() == 0


def test_two_phases_join_the_lines_once(spark):
    plan = plan_of(QUERIES["clean_claims_two_phase"](spark, TABLES))
    assert "l_partkey" in plan and "p_partkey" not in plan and "o_orderkey" not in plan


def shuffled_bytes(frame):
    """Bytes of the exchanges that an executed plan has written."""
    frame.collect()
    found, nodes = 0, [frame._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            nodes.append(node.plan())
            continue
        metric = node.metrics().get("shuffleBytesWritten")
        if metric.isDefined():
            found += metric.get().value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return found


def test_rows_come_back_from_the_shuffle_as_they_were(claims):
    odd = [
        {"claim_id": "0af3", "member_id": None}, {"claim_id": "0AF3", "denial_reason": ""}, {"claim_id": "abc"},
        {"claim_id": ""}, {"claim_id": "x y", "provider_type": "a\x1fb"}, {"claim_id": "ff", "plan_type": "\x00"},
        {"claim_id": None, "member_state": "ü", "provider_id": None}, {"claim_id": "\x1f"}, {"claim_id": "ff", "plan_type": "\x00"},
    ]
    fact = claims(*odd)
    broken = fact.limit(1).withColumn("plan_type", F.expr("CAST(X'FF41' AS STRING)"))
    for frame in (fact, broken, fact.limit(0), fact.select(MONTH, "paid_amount"), fact.select("plan_type", "member_id", MONTH)):
        sent = rebalanced(frame, MONTH)
        assert sent.schema == frame.schema or [(f.name, f.dataType) for f in sent.schema] == [(f.name, f.dataType) for f in frame.schema]
        assert row_differences(sent, frame).count() == 0
    assert rebalanced(broken, MONTH).select(F.hex("plan_type")).first()[0] == "FF41"


def test_months_take_fewer_bytes_in_the_shuffle(spark, feed):
    fact = clean(feed(*[
        {"claim_id": hashlib.md5(str(i).encode()).hexdigest(), "member_id": f"MBR-{i % 97}", "provider_id": f"PRV-{i % 13}",
         "plan_type": ["HMO", "PPO", "EPO"][i % 3], "member_state": ["CA", "TX"][i % 2], "paid_amount": str(i % 371)} for i in range(4000)
    ])).localCheckpoint()
    assert shuffled_bytes(rebalanced(fact, MONTH)) < 0.8 * shuffled_bytes(fact.hint("rebalance", MONTH))


@pytest.mark.parametrize("name", ["load_path_partition", "load_mixed_files", "reconcile_three_sides"])
def test_a_fact_of_once_joined_lines(spark, name):
    joined = []
    original = queries.claims_feed
    try:
        queries.claims_feed = lambda spark, tables, with_flag=False, lines=None: joined.append(lines) or original(spark, tables, with_flag, lines)
        QUERIES[name](spark, TABLES)
    finally:
        queries.claims_feed = original
    assert joined and all(lines is not None for lines in joined)


@pytest.mark.parametrize("broadcast", [True, False])
def test_survivors_in_two_parts(spark, feed, broadcast):
    draw = random.Random(9)
    raw = feed(*[
        {"claim_id": draw.choice([f"c{draw.randint(0, 30)}", f"d{i}", None]), "paid_amount": str(draw.randint(0, 9)),
         "billed_amount": draw.choice(["5", "-1", "x"]), "member_id": draw.choice(["m", None])} for i in range(300)
    ]).repartition(5)
    alone, several = survivors_of_repeats(raw, repeated_keys(raw, "claim_id"), broadcast)
    assert row_differences(alone.unionByName(several), survivors_with_reasons(raw).where("claim_id IS NOT NULL")).count() == 0
    assert several.count() <= 31


def sided(spark, values):
    return spark.createDataFrame(values, "k string, v double")


def test_sides_against_brute_force(spark):
    """Equal and unequal sides in any combination, repeated rows, missing keys, an empty side."""
    draw = random.Random(4)
    base = [(draw.choice([f"k{i}", f"k{i % 50}", None]), float(draw.randint(0, 3))) for i in range(600)]
    changed = [(k, v + (draw.random() < 0.1)) for k, v in base if draw.random() < 0.9]
    fewer = [r for r in base if draw.random() < 0.5]
    for chosen in ((base, changed), (base, changed, changed), (changed, base, changed, fewer), (base, [], base), ([("a", 1.0)] * 300, [])):
        sides = {f"s{i}": sided(spark, rows).repartition(3) for i, rows in enumerate(chosen)}
        counts = [Counter(rows) for rows in chosen]
        agree = sum(n for r, n in counts[0].items() if all(c[r] == n for c in counts))
        got = {r["side"]: (r["total_rows"], r["agreeing_rows"], r["differing_rows"]) for r in reconcile_sides(sides, ["k"]).collect()}
        assert got == {f"s{i}": (len(rows), agree, len(rows) - agree) for i, rows in enumerate(chosen)}


def test_only_keys_that_differ_are_compared(spark):
    """Every third range differs, but few keys do."""
    base = [(f"k{i}", float(i)) for i in range(16000)]
    without = [r for r in base if r[1] % 10]
    got = reconcile_sides({n: sided(spark, r) for n, r in (("a", base), ("b", without), ("c", without))}, ["k"]).collect()
    found = {r["side"]: r["compared_rows"] for r in got}
    assert 1600 <= found["a"] <= 1610 and found["b"] == found["c"] <= 10
