"""Sequence packing with optimal length buckets.

Documents become pieces of at most ``max_length`` tokens. Dynamic programming over the
global histogram of piece lengths chooses the bucket boundaries that minimise padding.
Inside each bucket, batches of equally padded pieces are formed within a token budget.

The histogram has at most ``max_length`` rows and is all that reaches the driver. Pieces
are numbered in two steps: counts of (bucket, shard) give offsets, and rows are ordered
inside their shard only. A bucket that holds most of the pieces is thus spread over its
shards, and the numbering is still gapless.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payerlens.llm.tables import stored
from payerlens.llm.tokens import word_count

MAX_LENGTH = 1024
BUCKETS = 8
TOKEN_BUDGET = 16_384
SEED = 17
COPY_CHUNK = 10_000  # repeated rows that a task numbers at once
SHARD_DIGITS = 3  # hex digits of the order key: 4096 shards a bucket


def optimal_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """At most ``buckets`` upper bounds, each an occurring length, with the least padding.

    ``lengths`` ascend. Of several optima the one is taken whose last buckets begin
    earliest. Quadratic in the number of distinct lengths.
    """
    size = np.asarray(lengths, np.int64)
    count = np.concatenate([[0], np.cumsum(np.asarray(counts, np.int64))])
    n = len(size)
    if not n:
        return []
    # Padded tokens suffice: the real ones are the same for every choice.
    worst = np.iinfo(np.int64).max // 4
    best = np.full(n + 1, worst)
    best[0] = 0
    choice = []
    for _ in range(min(buckets, n)):
        following, start = best.copy(), np.full(n + 1, -1)
        for end in range(1, n + 1):
            cost = best[:end] + size[end - 1] * (count[end] - count[:end])
            at = int(cost.argmin())
            if cost[at] < following[end]:
                following[end], start[end] = cost[at], at
        best = following
        choice.append(start)
    bounds, end, level = [], n, len(choice) - 1
    while end > 0:
        start = choice[level][end]
        level -= 1
        if start < 0:
            continue
        bounds.append(int(size[end - 1]))
        end = int(start)
    return bounds[::-1]


def _order_key(seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("name"), F.col("piece").cast("string")))


def _documents(docs: DataFrame, id_column: str, text_column: str, count: Column) -> DataFrame:
    """(doc_id, name, n_tokens, copies): ``name`` is the id, or a hash of the text where there is none.

    Rows that agree in all of these are one row with their number, counted on the map side.
    """
    doc_id, text = F.col(f"`{id_column}`"), F.col(f"`{text_column}`").cast("string")
    unnamed = F.concat(F.lit("text:"), F.coalesce(F.sha2(text, 256), F.lit("null")))
    rows = docs.select(
        doc_id.alias("doc_id"), F.coalesce(doc_id.cast("string"), unnamed).alias("name"), count.cast("long").alias("n_tokens")
    )
    return rows.groupBy("doc_id", "name", "n_tokens").agg(F.count("*").alias("copies"))


def _each_copy(pieces: DataFrame) -> DataFrame:
    """One row for each of a piece's ``copies``, numbered from 0 in ``copy``; many copies by many tasks."""
    zero = F.lit(0).cast("long")
    few = pieces.where(F.col("copies") <= COPY_CHUNK).withColumn("copy", F.explode(F.sequence(zero, F.col("copies") - 1)))
    chunks = pieces.where(F.col("copies") > COPY_CHUNK).withColumn(
        "first", F.explode(F.sequence(zero, F.col("copies") - 1, F.lit(COPY_CHUNK).cast("long")))
    )
    last = F.least(F.col("first") + COPY_CHUNK, F.col("copies")) - 1
    many = chunks.repartition("name", "piece", "first").withColumn("copy", F.explode(F.sequence("first", last))).drop("first")
    return few.unionByName(many)


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokens: Column | None = None,
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    seed: int = SEED,
) -> DataFrame:
    """One row per piece: doc_id, piece, token_start, length, bucket, padded_length, batch, slot.

    A document of n tokens gives pieces of ``max_length`` tokens and the rest; token_start
    and length are its spans. ``bucket`` counts from 0, ``padded_length`` is its boundary,
    ``batch`` counts from 0 inside the bucket and holds at most
    ``token_budget // padded_length`` pieces (one at least), ``slot`` is the place in it.
    Order inside a bucket follows an MD5 of seed, doc_id and piece; without doc_id, of the text.

    Null, empty and blank texts have no tokens: one row of length 0 without bucket and
    batch. Repeated rows are pieces of their own; they are counted first and take neighbouring
    numbers. A missing doc_id is kept as null.
    """
    count = word_count(F.col(f"`{text_column}`")) if tokens is None else tokens
    counted = _documents(docs, id_column, text_column, count)
    last = F.greatest(F.ceil(F.col("n_tokens") / max_length) - 1, F.lit(0)).cast("long")
    pieces = counted.select(
        "doc_id", "name", "copies", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")
    ).select(
        "doc_id",
        "name",
        "copies",
        "piece",
        (F.col("piece") * max_length).alias("token_start"),
        F.least(
            F.lit(max_length).cast("long"), F.col("n_tokens") - F.col("piece") * max_length
        ).alias("length"),
        F.substring(_order_key(seed), 1, SHARD_DIGITS).alias("shard"),
    )
    pieces = stored(pieces, "pieces")
    filled = pieces.where("length > 0")
    histogram = sorted(filled.groupBy("length").agg(F.sum("copies")).collect())
    bounds = optimal_boundaries([r[0] for r in histogram], [r[1] for r in histogram], buckets)

    bucket = F.lit(None).cast("int")
    padded = F.lit(None).cast("long")
    for number, bound in reversed(list(enumerate(bounds))):
        bucket = F.when(F.col("length") <= bound, F.lit(number)).otherwise(bucket)
        padded = F.when(F.col("length") <= bound, F.lit(bound).cast("long")).otherwise(padded)
    filled = filled.withColumn("bucket", bucket).withColumn("padded_length", padded)
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        filled.groupBy("bucket", "shard").agg(F.sum("copies").alias("n"))
        .select("bucket", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    inside = (
        Window.partitionBy("bucket", "shard").orderBy(_order_key(seed), "doc_id", "piece", "length", "name")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first_number = F.col("offset") + F.coalesce(F.sum("copies").over(inside), F.lit(0))
    batch_size = F.greatest(F.floor(F.lit(token_budget) / F.col("padded_length")), F.lit(1))
    packed = (
        _each_copy(filled.join(offsets, ["bucket", "shard"]).withColumn("first_number", first_number))
        .withColumn("number", F.col("first_number") + F.col("copy"))
        .select(
            "doc_id",
            "piece",
            "token_start",
            "length",
            "bucket",
            "padded_length",
            F.floor(F.col("number") / batch_size).cast("long").alias("batch"),
            (F.col("number") % batch_size).cast("int").alias("slot"),
        )
    )
    empty = _each_copy(pieces.where("length <= 0")).select(
        "doc_id",
        "piece",
        "token_start",
        "length",
        F.lit(None).cast("int").alias("bucket"),
        F.lit(None).cast("long").alias("padded_length"),
        F.lit(None).cast("long").alias("batch"),
        F.lit(None).cast("int").alias("slot"),
    )
    return packed.unionByName(empty)
