"""The registered queries: each takes a session and a folder of order tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payerlens.functions import dollars
from payerlens.operators.cleaning import (
    audit_by_rule,
    audit_rows,
    clean,
    clean_repeats,
    keep_one_per_key,
    repeated_keys,
    survivors_of_repeats,
)
from payerlens.operators.member_sets import (
    member_sets,
    monthly_totals,
    number_members,
    pmpm_from_sets,
    rolling_members,
    spend_from_sets,
)
from payerlens.operators.members import flag_inpatient, readmission_days
from payerlens.operators.narrow_rows import rebalanced
from payerlens.operators.providers import provider_profile
from payerlens.operators.reconcile import range_digests, reconcile, reconcile_sides
from payerlens.operators.spend import monthly_spend
from payerlens.plans.analyst_sql import run_sql
from payerlens.plans.reports import FEEDS, FROM_PROFILE, REPORTS
from payerlens.plans.workspace import shared_folder, store
from payerlens.schemas import FACT_COLUMNS, FLAG, INPATIENT, MONEY, MONEY_COLUMNS, MONTH
from payerlens.sources.order_feed import claims_feed, order_lines
from payerlens.sources.tables import (
    FACT,
    read_aggregate,
    read_fact,
    read_fact_by_path,
    table_path,
    write_aggregate,
    write_fact,
)

Query = Callable[[SparkSession, str], DataFrame]

MOST_REPEATS = 2_000_000  # repeating claim ids, 16 MB of hashes, that are sent to all tasks

# Reports that read the readmission flag; all others skip the join that sets it.
_NEEDS_FLAG = {"readmissions"}


def _stored_feed(spark: SparkSession, tables: str, with_flag: bool = False) -> DataFrame:
    """The feed on stored order lines: their joins run once, however often it is read."""
    lines = store(order_lines(spark, tables), shared_folder(spark, "order-lines"))
    return claims_feed(spark, tables, with_flag, lines)


def _claims(spark: SparkSession, tables: str, with_flag: bool = False) -> DataFrame:
    return clean(claims_feed(spark, tables, with_flag))


def clean_claims(spark: SparkSession, tables: str) -> DataFrame:
    claims = _claims(spark, tables, with_flag=True)
    return claims.select(
        *[dollars(F.col(c)).alias(c) if c in MONEY_COLUMNS else c for c in FACT_COLUMNS]
    )


def row_audit(spark: SparkSession, tables: str) -> DataFrame:
    return audit_rows(claims_feed(spark, tables))


def readmission_flag(spark: SparkSession, tables: str) -> DataFrame:
    """Distinct inpatient claims of known members, before cleaning, with their flag."""
    feed = claims_feed(spark, tables).where(
        (F.col("claim_type") == INPATIENT) & F.col("member_id").isNotNull()
    )
    distinct = keep_one_per_key(feed, "claim_id")
    return flag_inpatient(distinct, readmission_days(feed)).select(
        "claim_id", "member_id", "service_date", FLAG
    )


def load_path_partition(spark: SparkSession, tables: str) -> DataFrame:
    """Writes the fact by month, bulk-loads it with months from the paths, sums it up."""
    base = shared_folder(spark, "load_path_partition")
    write_fact(two_phase_claims(_stored_feed(spark, tables, with_flag=True)), base)
    loaded = read_fact_by_path(spark, table_path(base, FACT))

    def exact_total(name: str):
        return dollars(F.sum(F.col(name).cast(MONEY)))

    return loaded.groupBy(MONTH).agg(
        F.count("*").alias("claim_count"),
        *[exact_total(c).alias(f"total_{c.removesuffix('_amount')}") for c in MONEY_COLUMNS],
        F.count_if(FLAG).alias("readmissions"),
        F.min("service_date").alias("first_service_date"),
        F.max("submission_date").alias("last_submission_date"),
    )


def reconcile_monthly(spark: SparkSession, tables: str) -> DataFrame:
    """Stored monthly aggregate against the same question asked in SQL of the fact.

    The columns that both sides need are stored once, so the feed is cleaned once.
    """
    base, name = shared_folder(spark, "reconcile_monthly"), "agg_monthly_spend"
    columns = [MONTH, "plan_type", "member_id", "billed_amount", "paid_amount"]
    claims = store(_claims(spark, tables).select(*columns), table_path(base, FACT))
    write_aggregate(monthly_spend(claims), base, name)
    return reconcile(
        read_aggregate(spark, base, name), run_sql(spark, "monthly_spend", claims=claims), name
    )


def audit_of_rules(spark: SparkSession, tables: str) -> DataFrame:
    """What each cleaning rule rejects; the row of what passes is named ``none``."""
    return audit_by_rule(claims_feed(spark, tables)).withColumn("rule", F.coalesce("rule", F.lit("none")))


def clean_claims_two_phase(spark: SparkSession, tables: str) -> DataFrame:
    """The clean claims; only rows of claim ids that repeat are shuffled to find survivors."""
    claims = two_phase_claims(_stored_feed(spark, tables, with_flag=True))
    return claims.select(
        *[dollars(F.col(c)).alias(c) if c in MONEY_COLUMNS else c for c in FACT_COLUMNS]
    )


def two_phase_claims(feed: DataFrame, most_broadcast: int = MOST_REPEATS) -> DataFrame:
    return clean_repeats(feed, *_repeats(feed, most_broadcast))


def _repeats(feed: DataFrame, most_broadcast: int) -> tuple[DataFrame, bool]:
    """The stored hashes of repeating claim ids, and whether they are few enough to be broadcast."""
    repeats = store(repeated_keys(feed, "claim_id"), shared_folder(feed.sparkSession, "repeated-claims"))
    return repeats, repeats.count() <= most_broadcast


def _member_tables(spark: SparkSession, tables: str) -> tuple[DataFrame, DataFrame]:
    """Stored totals and member sets of the clean claims; what reads them does not read the claims."""
    columns = [MONTH, "plan_type", "member_id", "billed_amount", "paid_amount"]
    claims = store(_claims(spark, tables).select(*columns), shared_folder(spark, "claims"))
    numbers = store(number_members(claims), shared_folder(spark, "member-numbers"))
    return tuple(
        store(df, shared_folder(spark, name))
        for name, df in (("monthly-totals", monthly_totals(claims)), ("member-sets", member_sets(claims, numbers)))
    )


def monthly_spend_from_sets(spark: SparkSession, tables: str) -> DataFrame:
    return spend_from_sets(*_member_tables(spark, tables))


def monthly_pmpm_from_sets(spark: SparkSession, tables: str) -> DataFrame:
    return pmpm_from_sets(*_member_tables(spark, tables))


def rolling_quarter_members(spark: SparkSession, tables: str) -> DataFrame:
    """Members with a claim in a month or the two before it, by plan."""
    return rolling_members(_member_tables(spark, tables)[1])


def reconcile_three_sides(spark: SparkSession, tables: str) -> DataFrame:
    """Feed, curated fact and bulk-loaded copy by claim: rejected claims are what differs.

    The feed counts each distinct claim id once, whatever the rules say of it.
    """
    base = shared_folder(spark, "reconcile_three_sides")
    feed = _stored_feed(spark, tables)
    alone, several = survivors_of_repeats(feed, *_repeats(feed, MOST_REPEATS))
    survivors = alone.unionByName(store(several, table_path(base, "survivors")))
    write_fact(survivors.where("_reasons = 0").select(*FACT_COLUMNS), base)
    amounts = [F.col(c).cast(MONEY).alias(c) for c in ("billed_amount", "paid_amount")]
    sides = {
        name: side.select("claim_id", "member_id", MONTH, *amounts)
        for name, side in (
            ("feed", survivors),
            ("fact", read_fact(spark, base)),
            ("warehouse", read_fact_by_path(spark, table_path(base, FACT))),
        )
    }
    digests = store(range_digests(sides, ["claim_id"]), table_path(base, "digests"))
    # How many rows are compared depends on hashes only.
    return reconcile_sides(sides, ["claim_id"], digests).drop("compared_rows")


def load_mixed_files(spark: SparkSession, tables: str) -> DataFrame:
    """Three files of differing types in each month's directory, loaded together and summed up."""
    path = shared_folder(spark, "load_mixed_files")
    claims = store(two_phase_claims(_stored_feed(spark, tables)), f"{path}/claims")
    kinds = {0: "double", 1: "string", 2: "decimal(20,4)"}
    for part, money in kinds.items():
        third = claims.where(F.pmod(F.xxhash64("claim_id"), F.lit(len(kinds))) == part).withColumns(
            {c: F.col(c).cast(money) for c in MONEY_COLUMNS}
        )
        rebalanced(third, MONTH).write.mode("append").partitionBy(MONTH).parquet(f"{path}/staged")
    loaded = read_fact_by_path(spark, f"{path}/staged")
    return loaded.groupBy(MONTH).agg(
        F.count("*").alias("claim_count"),
        *[dollars(F.sum(F.col(c).cast(MONEY))).alias(f"total_{c.removesuffix('_amount')}") for c in MONEY_COLUMNS],
    )


def _source(spark: SparkSession, tables: str, report: str) -> DataFrame:
    """What a report reads: the clean claims, or the provider profile.

    The profile is stored first because its reports read it twice; it has one
    row per provider.
    """
    claims = _claims(spark, tables, with_flag=report in _NEEDS_FLAG)
    if report in FROM_PROFILE:
        return store(provider_profile(claims), shared_folder(spark, report))
    return claims


def _report(spark: SparkSession, tables: str, name: str) -> DataFrame:
    return REPORTS[name].run(_source(spark, tables, name))


def _feed(spark: SparkSession, tables: str, name: str) -> DataFrame:
    source, feed = FEEDS[name]
    aggregate = REPORTS[source].build(_source(spark, tables, source))
    if name == "monthly_spend_pivot":  # read twice: for its plans and for its sums
        aggregate = store(aggregate, shared_folder(spark, name))
    return feed.run(aggregate)


QUERIES: dict[str, Query] = {
    "clean_claims": clean_claims,
    "row_audit": row_audit,
    "readmission_flag": readmission_flag,
    "load_path_partition": load_path_partition,
    "reconcile_monthly": reconcile_monthly,
    "audit_by_rule": audit_of_rules,
    "clean_claims_two_phase": clean_claims_two_phase,
    "monthly_spend_from_sets": monthly_spend_from_sets,
    "pmpm_from_sets": monthly_pmpm_from_sets,
    "rolling_quarter_members": rolling_quarter_members,
    "reconcile_three_sides": reconcile_three_sides,
    "load_mixed_files": load_mixed_files,
    **{name: partial(_report, name=name) for name in REPORTS},
    **{name: partial(_feed, name=name) for name in FEEDS},
}
