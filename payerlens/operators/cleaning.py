"""Parse, de-duplicate and filter the raw feed; audit row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payerlens.functions import null_aware_hash
from payerlens.operators.key_bits import key_bits, with_bit
from payerlens.schemas import (
    CLAIM_STATUSES,
    DATE_COLUMNS,
    FACT_COLUMNS,
    FLAG,
    MONEY_COLUMNS,
    MONTH,
    RAW_COLUMNS,
)

_VALID = "_valid"
_RANK = "_survivor_rank"
_ROW = "_row_number"
_KEY_HASH = "_key_hash"
_SEVERAL = "_several"
REASONS, COPIES = "_reasons", "_copies"


def _typed() -> dict[str, str]:
    types = dict.fromkeys(DATE_COLUMNS, "DATE") | dict.fromkeys(MONEY_COLUMNS, "DECIMAL(18, 2)")
    types[FLAG] = "BOOLEAN"
    return {c: f"try_cast({c} AS {types[c]})" if c in types else c for c in RAW_COLUMNS}


def rules() -> dict[str, str]:
    """Name and condition of each cleaning rule; a row is clean if all hold.

    The range rule looks at the unrounded amount: -0.001 is negative although its two-decimal
    value is 0. Amounts that no decimal(18,2) can hold (NaN, overflow) are rejected as dates are
    that nothing can be read from.
    """
    typed = _typed()
    statuses = ", ".join(f"'{s}'" for s in CLAIM_STATUSES)
    return {
        "claim_id_missing": "claim_id IS NOT NULL",
        "member_id_missing": "member_id IS NOT NULL",
        "service_date_unreadable": f"{typed['service_date']} IS NOT NULL",
        "claim_status_unknown": f"claim_status IN ({statuses})",
        "billed_amount_negative": "try_cast(billed_amount AS DOUBLE) >= 0",
        "billed_amount_unreadable": f"{typed['billed_amount']} IS NOT NULL",
    }


def parse(feed: DataFrame) -> DataFrame:
    """Typed columns, plus ``_valid``: does this row pass the cleaning rules?

    Dirt becomes NULL, never an error, whatever the ANSI setting. Doing this row-wise work
    below the de-duplication keeps the shuffled rows narrow; only one boolean stands for
    all the rules.
    """
    valid = " AND ".join(rules().values())
    return feed.selectExpr(
        *[f"{expression} AS {name}" for name, expression in _typed().items()],
        f"coalesce({valid}, false) AS {_VALID}",
    )


def parse_with_reasons(feed: DataFrame) -> DataFrame:
    """Typed columns, plus ``_reasons``: a bit for each rule that the row fails, in their order."""
    bits = " | ".join(f"IF(coalesce({c}, false), 0, {1 << i})" for i, c in enumerate(rules().values()))
    return feed.selectExpr(
        *[f"{expression} AS {name}" for name, expression in _typed().items()], f"{bits} AS {REASONS}"
    )


def _rank() -> Column:
    """The order of copies in ``keep_one_per_key(parse(feed))``, beside ``_reasons``."""
    return F.expr("xxhash64(" + ", ".join(
        f"{c}, ({c}) IS NULL" for c in [*RAW_COLUMNS, f"({REASONS} = 0)"]) + ")")


def fails(rule: str) -> Column:
    """Is the bit of a rule set in ``_reasons``?"""
    return F.col(REASONS).bitwiseAND(1 << list(rules()).index(rule)) != 0


def keep_one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per non-NULL key; the survivor depends on row contents only.

    ``row_number() = 1`` lets Catalyst add a partial group limit below the
    exchange: every map task forwards at most one row per key, so a key that
    holds a third of the feed reaches its reducer as one row per map task. The
    order is a hash of the whole row, so the shuffle carries eight bytes
    instead of every column that a query does not need.
    """
    window = Window.partitionBy(key).orderBy(_RANK)
    return (
        df.where(F.col(key).isNotNull())
        .withColumn(_RANK, null_aware_hash(df.columns))
        .withColumn(_ROW, F.row_number().over(window))
        .where(F.col(_ROW) == 1)
        .drop(_RANK, _ROW)
    )


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """(key_hash) of the keys that occur more than once, and of the few whose hash another key has.

    Eight bytes and a count of each row are shuffled, combined on the map side.
    """
    hashes = df.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias(_KEY_HASH))
    return hashes.groupBy(_KEY_HASH).count().where("count > 1").select(_KEY_HASH)


def split_repeats(df: DataFrame, key: str, repeats: DataFrame, broadcast: bool) -> tuple[DataFrame, DataFrame]:
    """The rows of keys that occur once, and all others; rows without key are in neither.

    ``repeats`` is the stored result of ``repeated_keys``. It is sent to all tasks if
    ``broadcast`` says that its size was checked; else the bits of its hashes are, whatever
    their number: some rows that occur once are then among the others, and no row of ``df`` is
    shuffled to find out.
    """
    marked = df.where(F.col(key).isNotNull()).withColumn(_KEY_HASH, F.xxhash64(key))
    if broadcast:
        found = F.broadcast(repeats)
        return tuple(marked.join(found, _KEY_HASH, kind).drop(_KEY_HASH) for kind in ("left_anti", "left_semi"))
    screened = with_bit(marked, _KEY_HASH, key_bits(repeats, _KEY_HASH), _SEVERAL)
    return tuple(screened.where(rows).drop(_KEY_HASH, _SEVERAL) for rows in (~F.col(_SEVERAL), F.col(_SEVERAL)))


def keep_one_of_repeats(df: DataFrame, key: str, repeats: DataFrame, broadcast: bool) -> DataFrame:
    """As ``keep_one_per_key``, but only the second part of ``split_repeats`` is shuffled."""
    alone, several = split_repeats(df, key, repeats, broadcast)
    return alone.unionByName(keep_one_per_key(several, key))


def _with_month(claims: DataFrame) -> DataFrame:
    return claims.withColumn(MONTH, F.date_format("service_date", "yyyy-MM"))


def clean(feed: DataFrame) -> DataFrame:
    """The curated fact: 18 typed columns and ``service_month``.

    De-duplication comes before the filters: a claim whose surviving copy is
    invalid is dropped, not replaced by another copy.
    """
    survivors = keep_one_per_key(parse(feed), "claim_id").where(F.col(_VALID))
    return _with_month(survivors).select(*FACT_COLUMNS)


def clean_repeats(feed: DataFrame, repeats: DataFrame, broadcast: bool) -> DataFrame:
    """What ``clean`` gives, by ``keep_one_of_repeats``."""
    survivors = keep_one_of_repeats(parse(feed), "claim_id", repeats, broadcast).where(F.col(_VALID))
    return _with_month(survivors).select(*FACT_COLUMNS)


def survivors_with_reasons(feed: DataFrame) -> DataFrame:
    """The surviving copy of every claim, valid or not: the fact's columns, _reasons and _copies.

    ``_copies`` counts the rows of the feed that the survivor stands for, so the
    result knows the size of the feed. Rows without claim id are one row that fails.
    The grouping combines on the map side: a hot claim id sends one row from each task.
    """
    return _survivors(parse_with_reasons(feed))


def _survivors(parsed: DataFrame) -> DataFrame:
    best = F.min_by(F.struct(*parsed.columns), F.struct(_rank(), F.col(REASONS)))
    one = parsed.groupBy("claim_id").agg(F.count("*").alias(COPIES), best.alias("_best"))
    return _with_month(one.select("_best.*", COPIES)).select(*FACT_COLUMNS, REASONS, COPIES)


def survivors_of_repeats(feed: DataFrame, repeats: DataFrame, broadcast: bool) -> tuple[DataFrame, DataFrame]:
    """What ``survivors_with_reasons`` gives of the rows with claim id, in the two parts of ``split_repeats``.

    Only the second part is shuffled; whoever reads the survivors several times stores it.
    """
    alone, several = split_repeats(parse_with_reasons(feed), "claim_id", repeats, broadcast)
    once = _with_month(alone).withColumn(COPIES, F.lit(1).cast("long"))
    return once.select(*FACT_COLUMNS, REASONS, COPIES), _survivors(several)


def rule_counts() -> list[Column]:
    """Aggregates over survivors with reasons: rows of the feed, clean claims, rejects by rule."""
    claims = F.col("claim_id").isNotNull()
    return [
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("raw_rows"),
        F.count_if(F.col(REASONS) == 0).alias("clean_rows"),
        *[F.count_if(fails(rule) & (claims if rule != "claim_id_missing" else F.lit(True))).alias(rule) for rule in rules()],
    ]


def audit_by_rule(feed: DataFrame) -> DataFrame:
    """(rule, raw_rows, claims, only_rule): what each rule rejects.

    ``raw_rows`` of the feed fail the rule, the surviving copies of ``claims`` claims do, and
    ``only_rule`` of these fail no other. Rows without claim id are no claims. The row of
    rule NULL counts what fails nothing. One grouping by claim of numbers only.
    """
    parsed = parse_with_reasons(feed)
    names = list(rules())
    passed = F.col(REASONS) == 0
    per_claim = parsed.withColumn(_RANK, _rank()).groupBy("claim_id").agg(
        F.min_by(REASONS, F.struct(_RANK, REASONS)).alias(REASONS),
        F.count_if(passed).alias("raw_passed"),
        *[F.count_if(fails(n)).alias(f"raw_{n}") for n in names],
    )
    claim = F.col("claim_id").isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sums = per_claim.agg(
        total("raw_passed").alias("raw_passed"),
        F.count_if(claim & passed).alias("claims_passed"),
        *[total(f"raw_{n}").alias(f"raw_{n}") for n in names],
        *[F.count_if(claim & fails(n)).alias(f"claims_{n}") for n in names],
        *[F.count_if(claim & (F.col(REASONS) == 1 << i)).alias(f"only_{n}") for i, n in enumerate(names)],
    )
    row = lambda rule, raw, claims, only: F.struct(
        rule.cast("string").alias("rule"), raw.alias("raw_rows"), claims.alias("claims"), only.alias("only_rule")
    )
    rows = [row(F.lit(n), F.col(f"raw_{n}"), F.col(f"claims_{n}"), F.col(f"only_{n}")) for n in names]
    rows.append(row(F.lit(None), F.col("raw_passed"), F.col("claims_passed"), F.lit(0).cast("long")))
    return sums.select(F.inline(F.array(*rows)))


def audit_rows(feed: DataFrame) -> DataFrame:
    """Raw and clean row counts in one pass.

    Per claim id only a copy counter, the best rank and that copy's verdict are
    kept, all fixed-width, so this is a hash aggregation with map-side combine
    and no sort. ``clean`` keeps the copy with the same lowest rank.
    """
    parsed = parse(feed)
    return (
        parsed.withColumn(_RANK, null_aware_hash(parsed.columns))
        .groupBy("claim_id")
        .agg(
            F.count("*").alias("copies"),
            F.min_by(_VALID, _RANK).alias("survives"),
        )
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_rows"),
            F.count_if("survives").alias("clean_rows"),
        )
    )
