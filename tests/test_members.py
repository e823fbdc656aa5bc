import random
from datetime import date, timedelta

from conftest import by, plan_of, rows

from payerlens.operators.feeds import readmission_bars
from payerlens.operators.members import (
    high_utilizers,
    readmission_days,
    readmissions,
    with_readmission_flag,
)

DAY = date(2026, 3, 1)
STAY = {"claim_type": "inpatient"}


def on(offset: int, **more) -> dict:
    return STAY | {"service_date": DAY + timedelta(days=offset)} | more


def test_gap_limits(claims):
    gaps = {"m0": 0, "m1": 1, "m30": 30, "m31": 31}
    frame = claims(*[on(d, member_id=m) for m, gap in gaps.items() for d in (0, gap)])
    got = {(r["member_id"], (r["service_date"] - DAY).days): r["is_readmission_within_30d"]
           for r in rows(with_readmission_flag(frame))}
    assert {m: got[m, gap] for m, gap in gaps.items()} == {
        "m0": False, "m1": True, "m30": True, "m31": False}
    assert not any(got[m, 0] for m in gaps)


def test_only_inpatient_claims_of_known_members_count(claims):
    frame = claims(
        on(0), on(5, claim_type="outpatient"), on(3, member_id=None), on(4, member_id=None),
        {"claim_type": None}, {"claim_type": "inpatient", "service_date": None},
    )
    flagged = with_readmission_flag(frame)
    assert flagged.count() == 6
    assert not any(r["is_readmission_within_30d"] for r in rows(flagged))


def test_against_brute_force(claims):
    rng = random.Random(5)
    data = [
        on(rng.randrange(200), claim_id=f"c{n}", member_id=f"m{min(rng.randrange(6), 2)}",
           claim_type=rng.choice(["inpatient", "inpatient", "lab"]))
        for n in range(120)
    ]
    expected = {
        r["claim_id"]: r["claim_type"] == "inpatient" and any(
            o["claim_type"] == "inpatient" and o["member_id"] == r["member_id"]
            and 0 < (r["service_date"] - o["service_date"]).days <= 30
            for o in data)
        for r in data
    }
    got = by(with_readmission_flag(claims(*data)), "claim_id")
    assert {k: v["is_readmission_within_30d"] for k, v in got.items()} == expected


def test_days_are_reduced_before_the_window(claims):
    """A member with very many claims brings one row per day to the window."""
    plan = plan_of(readmission_days(claims(on(0))))
    window = plan.index("Window [lag")
    assert window < plan.index("HashAggregate(keys=[member_id", window)


def test_denominator_is_inpatient_claims(claims):
    flag = {"is_readmission_within_30d": True}
    frame = claims(STAY | flag, STAY, STAY, *[{}] * 20)
    got = rows(readmissions(frame))
    assert got == [{"diagnosis_category": "diabetes", "inpatient_claims": 3,
                    "readmissions_30d": 1, "readmission_rate": 0.3333}]
    assert rows(readmission_bars(readmissions(frame)))[0]["label"] == "33.3%"


def test_all_unknown_flags_stay_unknown(claims):
    got = rows(readmissions(claims(STAY | {"is_readmission_within_30d": None})))[0]
    assert got["readmissions_30d"] is None and got["readmission_rate"] is None


def test_high_utilizers(claims):
    stays = [on(d, member_id=f"m{n:02}", paid_amount=5 if n < 24 else 1)
             for n in range(30) for d in range(3)]
    frame = claims(*stays, on(0, member_id="two", paid_amount=900),
                   on(1, member_id="two"), on(1, member_id="two", claim_type="lab"))
    got = rows(high_utilizers(frame))
    assert [r["member_id"] for r in got] == [f"m{n:02}" for n in range(25)]
    assert got[0]["inpatient_claim_count"] == 3 and got[0]["total_paid"] == 15.0
    assert "TakeOrderedAndProject" in plan_of(high_utilizers(frame))


def test_hot_member_and_day_is_split_in_the_join(spark):
    """A third of the claims on one member and day: the join reads them in several tasks."""
    feed = spark.range(0, 600_000, 1, 16).selectExpr(
        "concat('c', id) AS claim_id",
        "IF(id % 3 = 0, 'hot', concat('m', id % 50000)) AS member_id",
        "date_add(DATE'2026-01-01', IF(id % 3 = 0, 0, CAST(id % 397 AS INT))) AS service_date",
        "'inpatient' AS claim_type",
        "md5(CAST(id AS STRING)) AS payload",
    )
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "300k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        result = with_readmission_flag(feed).groupBy("is_readmission_within_30d").agg(
            {"payload": "max", "*": "count"}
        )
        assert sum(r["count(1)"] for r in result.collect()) == 600_000
        assert "SortMergeJoin(skew=true)" in plan_of(result)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
