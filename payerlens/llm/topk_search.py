"""Exact top-k inner products by norm buckets with coordinate or length pruning.

Vectors are ordered by length and cut into buckets of similar length. The longest bucket
gives every query a first lower bound of its k-th best score. For a query q and a bucket
whose longest member has length l, a candidate can only reach the bound t if its cosine is
at least t / (|q| l). Above 1 the bucket is skipped. Inside a bucket the local cosine
threshold decides how candidates are pruned: a high one bounds every coordinate of the unit
vector to a narrow range around the query's (the query's largest coordinates are tested), a
low one only prunes by length. What is left is verified by integer products, and the bound
rises from bucket to bucket of a task.

A task handles one tile: a block of queries and one bucket, both of bounded size. Buckets
skipped by all queries of a block are never sent. Equal vectors have equal lengths; a value
that fills many buckets is cut by row number like any other.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payerlens.llm.tables import pick, stored

BUCKET_ROWS = 512
QUERY_ROWS = 512
SCALE = 256
SLICES = 4096  # of a length class, by the id's hash
EXACT = 1 << 53  # up to here doubles hold every integer
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
FOCUS = 4  # coordinates tested by coordinate pruning
COORDINATE_FROM = 0.35  # local cosine threshold from which coordinates prune better
_SLACK = 1e-9


def usable_vectors(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v array<double>, norm): distinct rows that take part, components as whole numbers.

    Left out: null ids and vectors, empty vectors, and null or non-finite components (a
    component counts as non-finite if 256 times it is beyond the largest double).
    """
    vectors = pick(rows, vec_id=id_column, embedding=vector_column)
    scaled = lambda c: F.lit(SCALE).cast("double") * c.cast("double")
    # From 2^53 on a double is whole by itself; + 0.0 makes a negative zero positive.
    floored = lambda y: F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y) + F.lit(0.0)
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(scaled(c)) < F.lit(float("inf"))))
    usable = F.when(F.col("vec_id").isNotNull() & (F.size(x) > 0) & fine, True)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))
    return (
        vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: floored(scaled(c))).alias("v"))
        .distinct()
        .withColumn("norm", norm)
    )


def _numbered(rows: DataFrame, size: int) -> DataFrame:
    """Adds ``block``: rows cut into blocks of at most ``size``, longest vectors first.

    Lengths are first cut into classes about 3 % wide; counts of (dimension, class, slice of
    the id hash) give offsets, so no window sees more than such a slice.
    """
    rows = rows.withColumn("width", F.size("v")).withColumn(
        "length_class", -F.ceil(F.log1p("norm") * 32).cast("long")
    ).withColumn("slice", F.pmod(F.xxhash64("vec_id"), F.lit(SLICES)))
    keys = ["width", "length_class", "slice"]
    before = Window.partitionBy("width").orderBy("length_class", "slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = stored(
        rows.groupBy(*keys).agg(F.count("*").alias("n"))
        .select(*keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")),
        "vector-offsets",
    )
    inside = Window.partitionBy(*keys).orderBy(F.desc("norm"), "vec_id", "v")
    place = F.col("offset") + F.row_number().over(inside) - 1
    return rows.join(offsets, keys).select(
        "width", F.floor(place / size).cast("int").alias("block"), "vec_id", "v", "norm"
    )


def coordinate_ranges(units: np.ndarray, least: np.ndarray, focus: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of a unit vector's coordinate ``focus[i]`` if its cosine with ``units[i]`` is at least ``least[i]``."""
    q = np.take_along_axis(units, focus[:, None], 1)[:, 0]
    spread = np.sqrt(np.maximum(0.0, 1 - least * least)) * np.sqrt(np.maximum(0.0, 1 - q * q))
    low, high = q * least - spread, q * least + spread
    # An interior optimum: the coordinate may be as large as the whole vector.
    return np.where(q <= -least, -1.0, low) - _SLACK, np.where(q >= least, 1.0, high) + _SLACK


def exact_products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products of all pairs, as int64; beyond 64 bits the largest or smallest value.

    Doubles multiply as long as no partial sum can leave 2^53, 64-bit integers up to 2^63,
    Python's own integers beyond.
    """
    largest = [float(np.abs(m).max(initial=0.0)) for m in (queries, candidates)]
    most = largest[0] * largest[1] * queries.shape[1]
    if most < EXACT:
        return (queries @ candidates.T).astype(np.int64)
    if most < 2.0**62 and max(largest) < 2.0**62:
        return queries.astype(np.int64) @ candidates.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    products = np.dot(whole(queries), whole(candidates).T)
    return np.frompyfunc(lambda x: min(max(x, _LEAST), _MOST), 1, 1)(products).astype(np.int64)


class Bucket:
    """Candidates of similar length, in order of length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        norms = np.sqrt((vectors**2).sum(1))
        order = np.lexsort((ids, -norms))
        self.ids, self.vectors, self.norms = ids[order], vectors[order], norms[order]
        self.units = self.vectors / np.maximum(self.norms, 1e-300)[:, None]

    def possible(self, queries: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Which (query, candidate) can reach the query's bound, by length and coordinates.

        A bound at or below 0 bounds no cosine: nothing is pruned then, nor where lengths
        are beyond a double.
        """
        sizes = np.sqrt((queries**2).sum(1))
        open_ = ~(bounds > 0) | (sizes == 0) | ~np.isfinite(sizes) | ~np.isfinite(self.norms).all()
        reach = np.where(open_, 1.0, sizes)[:, None] * self.norms
        out = open_[:, None] | (reach >= bounds[:, None] * (1 - _SLACK))
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(open_, 2.0, bounds * (1 - _SLACK) / reach[:, 0])
        tested = np.flatnonzero((least >= COORDINATE_FROM) & (least <= 1))
        if len(tested):
            units = queries[tested] / sizes[tested, None]
            order = np.argsort(-np.abs(units), axis=1, kind="stable")[:, :FOCUS]
            for focus in order.T:
                low, high = coordinate_ranges(units, least[tested], focus)
                column = self.units[:, focus].T
                out[tested] &= (column >= low[:, None]) & (column <= high[:, None])
        return out

    def search(self, own: np.ndarray, queries: np.ndarray, k: int, bounds: np.ndarray) -> list[tuple[int, int, int]]:
        """(query row, vec_id, score) of up to k candidates of each query that reach its bound."""
        possible = self.possible(queries, bounds)
        possible &= self.ids[None, :] != own[:, None]
        columns = np.flatnonzero(possible.any(0))
        rows = np.flatnonzero(possible.any(1))
        if not len(rows):
            return []
        scores = exact_products(queries[rows], self.vectors[columns])
        # A bound that is no exact double may be rounded up.
        least = np.where(np.abs(bounds) < EXACT, bounds, bounds - np.abs(bounds) * 1e-12)[rows]
        found, at = np.nonzero(possible[np.ix_(rows, columns)] & (scores >= least[:, None]))
        ids, best = self.ids[columns][at], scores[found, at]
        order = np.lexsort((ids, ~best, found))
        found, ids, best = found[order], ids[order], best[order]
        place = np.arange(len(found)) - np.searchsorted(found, found)
        taken = place < k
        return list(zip(rows[found[taken]].tolist(), ids[taken].tolist(), best[taken].tolist(), strict=True))


def _tile_search(k: int) -> Callable:
    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found, own, vectors = [], np.zeros(0, np.int64), np.zeros((0, 1))
        if len(queries) and len(candidates):
            bucket = Bucket(
                candidates["vec_id"].to_numpy(np.int64), np.stack(candidates["v"].to_numpy()).astype(np.float64)
            )
            vectors = np.stack(queries["v"].to_numpy()).astype(np.float64)
            bounds = queries["bound"].to_numpy(np.float64)
            own = queries["vec_id"].to_numpy(np.int64)
            found = bucket.search(own, vectors, k, np.where(np.isnan(bounds), -np.inf, bounds))
        rows = np.array([r for r, _, _ in found], np.int64)
        return pd.DataFrame({
            "query_id": own[rows],
            # The query itself goes along: an id may stand for several vectors.
            "qv": pd.Series([vectors[r] for r in rows], dtype=object),
            "vec_id": np.array([i for _, i, _ in found], np.int64),
            "score": np.array([s for _, _, s in found], np.int64),
        })

    return search


_FOUND = "query_id bigint, qv array<double>, vec_id bigint, score bigint"


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "qv").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _tiles(queries: DataFrame, buckets: DataFrame, k: int) -> DataFrame:
    """Searches the tiles (width, qblock, bucket) that both sides name."""
    keys = ["width", "qblock", "bucket"]
    return (
        queries.groupBy(*keys).cogroup(buckets.groupBy(*keys))
        .applyInPandas(_tile_search(k), _FOUND)
    )


def top_products(
    rows: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    bucket_rows: int = BUCKET_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer products of every query.

    Components become floor(256 x), of any finite size; a score beyond 64 bits counts as the largest
    or smallest long. Candidates are all other ids with vectors of as many
    components; fewer than k give fewer rows. Ties go to the smaller vec_id. ``is_query`` is
    a condition on ``vec_id``. Rows that repeat id and vector count once; an id with several
    vectors is as many queries, none of which finds that id.
    """
    vectors = stored(_numbered(usable_vectors(rows, id_column, vector_column), bucket_rows), "vectors")
    buckets = vectors.withColumnRenamed("block", "bucket")
    queries = stored(
        _numbered(vectors.where(is_query).select("vec_id", "v", "norm"), query_rows)
        .withColumnRenamed("block", "qblock"),
        "queries",
    )

    first = buckets.where("bucket = 0").join(
        queries.groupBy("width").agg(F.max("qblock").alias("last")), "width"
    ).withColumn("qblock", F.explode(F.sequence(F.lit(0), F.col("last"))))
    seeded = stored(
        _top(
            _tiles(
                queries.withColumn("bucket", F.lit(0)).withColumn("bound", F.lit(None).cast("double")),
                first.select("width", "qblock", "bucket", "vec_id", "v"),
                k,
            ),
            k,
        ),
        "seed-results",
    )
    kth = seeded.where(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), F.col("qv").alias("v"), F.col("score").cast("double").alias("bound")
    )
    bounded = stored(queries.join(kth, ["vec_id", "v"], "left"), "bounded-queries")

    # Which buckets a block of queries may need: its least demand on a bucket's longest vector.
    demand = bounded.groupBy("width", "qblock").agg(
        F.min(F.when(F.col("bound") > 0, F.col("bound") / F.col("norm")).otherwise(0.0)).alias("least")
    )
    lengths = buckets.where("bucket > 0").groupBy("width", "bucket").agg(F.max("norm").alias("longest"))
    tiles = stored(
        demand.join(lengths, "width").where(F.col("least") * (1 - 1e-9) <= F.col("longest"))
        .select("width", "qblock", "bucket", "longest"),
        "search-tiles",
    )
    asked = bounded.join(tiles, ["width", "qblock"]).where(
        F.col("bound").isNull() | (F.col("bound") * (1 - 1e-9) <= F.col("norm") * F.col("longest"))
        | (F.col("bound") <= 0)
    )
    needed = buckets.join(tiles.select("width", "qblock", "bucket"), ["width", "bucket"])
    found = _tiles(
        asked.select("width", "qblock", "bucket", "vec_id", "v", "bound"),
        needed.select("width", "qblock", "bucket", "vec_id", "v"),
        k,
    )
    merged = _top(seeded.select("query_id", "qv", "vec_id", "score").unionByName(found), k)
    return merged.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
