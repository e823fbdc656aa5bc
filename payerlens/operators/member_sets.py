"""Distinct members that add up: exact bit maps of numbered members by month and plan.

Counts of distinct members of months do not add up to those of a quarter; sets do. Every member
gets a number from 0 on without gaps, and a set of members is a few maps of 32,768 bits. They
are stored by month and plan beside the totals that add up by themselves. Monthly
spend, PMPM and the members of any range of months follow without reading the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payerlens.functions import dollars, exact_ratio
from payerlens.schemas import MONTH

SHARDS = 1024  # of the numbering: each is ordered by itself, their sizes are summed up
_KEYS = [MONTH, "plan_type"]


def number_members(claims: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(member_id, number): dense numbers from 0; members that ``known`` numbers keep theirs.

    Members are ordered inside 1,024 shards of their hash, and only the shards' sizes, as many
    rows, are summed up in order: no task sees all members.
    """
    members = claims.where(F.col("member_id").isNotNull()).select("member_id").distinct()
    first = F.lit(0).cast("long")
    if known is not None:
        members = members.join(known, "member_id", "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0)).alias("first")).scalar()
    sharded = members.withColumn("shard", F.pmod(F.xxhash64("member_id"), F.lit(SHARDS)))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sharded.groupBy("shard").agg(F.count("*").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    place = F.row_number().over(Window.partitionBy("shard").orderBy("member_id")) - 1
    numbered = sharded.withColumn("place", place).join(offsets, "shard").select(
        "member_id", (first + F.col("offset") + F.col("place")).cast("long").alias("number")
    )
    return numbered if known is None else known.select("member_id", "number").unionByName(numbered)


def member_sets(claims: DataFrame, numbers: DataFrame) -> DataFrame:
    """(service_month, plan_type, chunk, members): the members with a claim, as bit maps."""
    seen = claims.select(*_KEYS, "member_id").distinct().join(numbers, "member_id")
    chunk = F.bitmap_bucket_number("number")
    return seen.groupBy(*_KEYS, chunk.alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("members")
    )


def monthly_totals(claims: DataFrame) -> DataFrame:
    """(service_month, plan_type, paid, billed, claims): exact sums, which add up."""
    return claims.groupBy(*_KEYS).agg(
        F.sum("paid_amount").alias("paid"), F.sum("billed_amount").alias("billed"), F.count("*").alias("claims")
    )


def _counts(sets: DataFrame, keys: list[str]) -> DataFrame:
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("members")).alias("distinct_members"))


def _same_keys(keys: list[str]):
    """NULL keys meet: a plan may be missing."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
    return condition


def spend_from_sets(totals: DataFrame, sets: DataFrame) -> DataFrame:
    """Monthly spend as ``spend.monthly_spend`` gives it, from the stored tables."""
    joined = totals.alias("t").join(_counts(sets, _KEYS).alias("s"), _same_keys(_KEYS), "left")
    return joined.select(
        *[f"t.{k}" for k in _KEYS],
        dollars(F.col("paid")).alias("total_paid"),
        dollars(F.col("billed")).alias("total_billed"),
        F.col("claims").alias("claim_count"),
        F.coalesce("distinct_members", F.lit(0)).alias("distinct_members"),
    )


def pmpm_from_sets(totals: DataFrame, sets: DataFrame) -> DataFrame:
    """PMPM as ``spend.pmpm`` gives it, from the stored tables."""
    joined = totals.alias("t").join(_counts(sets, _KEYS).alias("s"), _same_keys(_KEYS), "left")
    return joined.select(
        *[f"t.{k}" for k in _KEYS], exact_ratio(F.col("paid"), F.coalesce("distinct_members", F.lit(0)), 2).alias("pmpm")
    )


def members_of_range(sets: DataFrame, first_month: str, last_month: str) -> DataFrame:
    """(plan_type, distinct_members) of a range of months."""
    united = (
        sets.where(F.col(MONTH).between(first_month, last_month))
        .groupBy("plan_type", "chunk").agg(F.bitmap_or_agg("members").alias("members"))
    )
    return _counts(united, ["plan_type"])


def rolling_members(sets: DataFrame, months: int = 3) -> DataFrame:
    """(service_month, plan_type, distinct_members) of each month with claims and those before it.

    A range has ``months`` calendar months. The bit maps of a month go to the ranges it is in.
    """
    month = F.to_date(F.concat(MONTH, F.lit("-01")))
    ranges = F.transform(F.sequence(F.lit(0), F.lit(months - 1)), lambda i: F.date_format(F.add_months(month, i), "yyyy-MM"))
    spread = sets.withColumn("until", F.explode(ranges))
    united = spread.groupBy("until", "plan_type", "chunk").agg(
        F.bitmap_or_agg("members").alias("members"), F.max(F.col("until") == F.col(MONTH)).alias("own")
    )
    counted = united.groupBy("until", "plan_type").agg(
        F.sum(F.bitmap_count("members")).alias("distinct_members"), F.max("own").alias("own")
    )
    return counted.where("own").select(F.col("until").alias(MONTH), "plan_type", "distinct_members")
