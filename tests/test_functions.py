import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from conftest import rows
from pyspark.sql import functions as F

from payerlens.functions import exact_ratio, millions_label, null_aware_hash, percent_label
from payerlens.operators.cleaning import clean


def half_up(numerator: Decimal, denominator: int, digits: int) -> float:
    value = Fraction(numerator) / denominator
    scaled = abs(value) * 10**digits
    whole = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    return float(Decimal(whole if value >= 0 else -whole).scaleb(-digits))


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_exact_ratio_against_fractions(spark, digits):
    rng = random.Random(digits)
    cases = [
        (Decimal(rng.randrange(-10**rng.randrange(1, 15), 10**15)).scaleb(-2),
         rng.choice([1, 2, 3, 7, 8, 20, 64, 200, 1000, rng.randrange(1, 10**6)]))
        for _ in range(2000)
    ]
    frame = spark.createDataFrame(cases, "n decimal(28,2), d bigint")
    got = frame.select("n", "d", exact_ratio(F.col("n"), F.col("d"), digits).alias("r"))
    assert [(r.n, r.d, r.r) for r in got.collect()] == [
        (n, d, half_up(n, d, digits)) for n, d in cases]


def test_ratio_over_zero_is_null(spark):
    frame = spark.createDataFrame([(Decimal("1.00"), 0)], "n decimal(28,2), d bigint")
    assert rows(frame.select(exact_ratio(F.col("n"), F.col("d"), 2).alias("r"))) == [{"r": None}]


def test_hash_tells_nulls_apart(spark):
    frame = spark.createDataFrame([(1, None), (None, 1), (1, 1), (None, None)], "a int, b int")
    assert frame.select(null_aware_hash(frame.columns)).distinct().count() == 4


def test_labels(spark):
    frame = spark.createDataFrame([(43250000.0, 0.0815), (None, None)], "m double, p double")
    got = rows(frame.select(millions_label(F.col("m")).alias("m"),
                            percent_label(F.col("p")).alias("p")))
    assert got[0] == {"m": "$43.3M", "p": "8.2%"}
    assert got[1] == {"m": None, "p": None}
    assert half_up(Decimal("43250000"), 10**6, 1) == 43.3
    assert Decimal("8.15").quantize(Decimal("0.1"), ROUND_HALF_UP) == Decimal("8.2")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_cleaning_does_not_depend_on_ansi(spark, feed, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        frame = clean(feed(
            {"claim_id": "a", "paid_amount": "abc"},
            {"claim_id": "b", "service_date": "2026-02-30"},
            {"claim_id": "c", "billed_amount": "1e400"},
            {"claim_id": "d", "billed_amount": "12345678901234567.00"},
        ))
        assert [(r["claim_id"], r["paid_amount"]) for r in rows(frame)] == [("a", None)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
