"""Near-duplicate classes of documents: circulant MinHash, banding, exact verification.

Signatures need two permutations only. Both are bijections of 32-bit values: the first
scrambles the shingle hashes, the second is applied to the scrambled values shifted by
k around the circle, and the least result is coordinate k. Bands of four coordinates
make the bucket keys. Every link is confirmed on the full sets of 64-bit shingle hashes.

Texts with equal words are one class first, so exact copies are never paired. Pairs inside
a large bucket are not written out either:

1. every bucket pairs its members with its own smallest or largest member; links found so
   give components (most groups are then complete);
2. small buckets that still hold several components pair those members;
3. large ones are joined to families, families are cut into blocks, and two blocks meet in
   one task, which compares all their sets and returns links between components only.
   Blocks of a family's main component do not meet each other.

A pair that shares a bucket is thus always compared or already connected. Four
coordinates in 24 bands miss a pair of similarity 0.8 with probability 3e-6.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payerlens.llm.components import connected_components
from payerlens.llm.tables import pick, stored
from payerlens.llm.textbytes import column_bytes, mix64, small_batches, words

BANDS, ROWS = 24, 4
SMALL_BUCKET = 32
BLOCK = 256
# Up to so many ids (8 bytes each) a semi-join against the texts may be broadcast.
BROADCAST_IDS = 500_000
_BLOCK_SHINGLES = 1 << 15


def _scramble32(x: np.ndarray, first: int, second: int, out: np.ndarray, tmp: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit values, in place of ``out``."""
    if out is not x:
        np.copyto(out, x)
    np.right_shift(out, 16, out=tmp)
    np.bitwise_xor(out, tmp, out=out)
    np.multiply(out, np.uint32(first), out=out)
    np.right_shift(out, 15, out=tmp)
    np.bitwise_xor(out, tmp, out=out)
    np.multiply(out, np.uint32(second), out=out)
    np.right_shift(out, 16, out=tmp)
    np.bitwise_xor(out, tmp, out=out)
    return out


def circulant_minhash(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Signatures (rows x coordinates) of non-empty sets of 64-bit hashes."""
    out = np.empty((len(sets), coordinates), np.uint32)
    sizes = np.cumsum([0, *map(len, sets)])
    row = 0
    while row < len(sets):
        last = max(row + 1, int(np.searchsorted(sizes, sizes[row] + _BLOCK_SHINGLES, "right")) - 1)
        whole = np.concatenate(sets[row:last])
        base = (whole ^ (whole >> np.uint64(32))).astype(np.uint32)
        moved, tmp = np.empty_like(base), np.empty_like(base)
        _scramble32(base, 0x7FEB352D, 0x846CA68B, base, tmp)
        starts = (sizes[row:last] - sizes[row]).astype(np.int64)
        for k in range(coordinates):
            np.add(base, np.uint32(k), out=moved)
            _scramble32(moved, 0x85EBCA6B, 0xC2B2AE35, moved, tmp)
            out[row:last, k] = np.minimum.reduceat(moved, starts)
        row = last
    return out


def shingle_sets(column: pa.Array, width: int) -> tuple[list[np.ndarray], list[bytes]]:
    """Sorted distinct shingle hashes of every text and a digest of its word sequence."""
    raw, offsets = column_bytes(column)
    hashes, _, bounds = words(raw, offsets)
    whole = _joined(hashes, width)  # windows over the whole batch; those across rows stay unused
    rows, names = [], []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = hashes[start:end]
        names.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
        if len(own) >= width:
            rows.append(np.unique(whole[start : end - width + 1]))
        else:
            rows.append(_joined(own, len(own)) if len(own) else own)
    return rows, names


def _joined(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words."""
    n = max(0, len(hashes) - width + 1)
    joined = np.full(n, np.uint64(width))
    for i in range(width):
        joined = mix64(joined * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return joined


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each row; the band's number is part of it."""
    bands = signatures.reshape(len(signatures), -1, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64), bands.shape[:2])
    for i in range(ROWS):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, i])
    return keys


def _signature_rows(width: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets, names = shingle_sets(batch.column("text"), width)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = [np.zeros(0, np.uint64)] * len(sets)
            if full:
                found = band_keys(circulant_minhash([sets[i] for i in full], BANDS * ROWS))
                for i, own in zip(full, found, strict=True):
                    keys[i] = own
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(names, pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _lists(keys),
                ],
                ["doc_id", "words", "n_shingles", "bands"],
            )

    return rows


def _set_rows(width: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets, _ = shingle_sets(batch.column("text"), width)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(sets)], ["id", "shingles"])

    return rows


def _semi(texts: DataFrame, ids: DataFrame, kind: str = "left_semi") -> DataFrame:
    """Rows of ``texts`` whose doc_id is in the stored table ``ids``; or is not (left_anti)."""
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return texts.join(side, texts["doc_id"] == side["id"], kind)


def distinct_texts(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """``texts`` without repeated rows; ``repeated`` are the ids that have several rows.

    Rows that repeat id and text have one set: n sets of one id and m of another would make
    n x m rows of each pair. Only rows of such ids are shuffled for it.
    """
    if repeated.isEmpty():
        return texts
    return _semi(texts, repeated, "left_anti").unionByName(_semi(texts, repeated).distinct())


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. Each pair moves one set."""
    first = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    second = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(second, "b").join(first, "a")
    shared = F.size(F.array_intersect("sa", "sb"))
    na, nb = F.size("sa"), F.size("sb")
    near_size = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    return both.where(near_size & (100 * shared >= percent * (na + nb - shared))).select("a", "b")


def _tile_links(percent: int) -> Callable:
    """Compares the two blocks of a tile; returns links that connect its components."""

    def links(tile: pd.DataFrame) -> pd.DataFrame:
        sets = [np.asarray(s, np.int64) for s in tile["shingles"]]
        sizes = np.array([len(s) for s in sets])
        labels, side = tile["component"].to_numpy(), tile["side"].to_numpy()
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if (side == 1).any() else left
        order_l = _by_value([sets[i] for i in left])
        order_r = order_l if right is left else _by_value([sets[i] for i in right])
        shared = np.zeros((len(left), len(right)), np.int32)
        common, at_l, at_r = np.intersect1d(
            order_l[0], order_r[0], assume_unique=True, return_indices=True
        )
        for i, j in zip(at_l.tolist(), at_r.tolist(), strict=True):
            shared[np.ix_(order_l[1][i], order_r[1][j])] += 1
        union = sizes[left][:, None] + sizes[right][None, :] - shared
        near = (100 * shared >= percent * union) & (labels[left][:, None] != labels[right][None, :])
        i, j = np.nonzero(near)
        parent: dict[int, int] = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out = []
        for a, b in zip(labels[left[i]].tolist(), labels[right[j]].tolist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[x] = y
                out.append((a, b))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return links


def _by_value(sets: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct values in order and, for each, the rows that hold it."""
    flat = np.concatenate(sets)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, rows = flat[order], rows[order]
    values, starts = np.unique(flat, return_index=True)
    return values, np.split(rows, starts[1:])


def _large_bucket_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components inside large buckets, by block tiles of their families.

    ``members``: (key, id, component) of the buckets in question.
    """
    # Stored, so that a bucket of very many members is split by the skew join.
    hubs = stored(members.groupBy("key").agg(F.min("id").alias("b")), "bucket-hubs")
    families = connected_components(
        members.join(hubs, "key").select(F.col("id").alias("a"), "b")
    )
    rows = stored(
        members.select("id", "component").distinct()
        .join(families.withColumnRenamed("component", "family"), "id"),
        "families",
    )
    counted = rows.groupBy("family", "component").agg(F.count("*").alias("n"))
    main = counted.groupBy("family").agg(
        F.max(F.struct("n", F.col("component").alias("main"))).alias("top"),
        F.sum("n").alias("size"),
    ).select(
        "family",
        F.col("top.main").alias("main"),
        F.ceil(F.col("top.n") / BLOCK).cast("int").alias("main_blocks"),
        F.ceil((F.col("size") - F.col("top.n")) / BLOCK).cast("int").alias("other_blocks"),
    )
    placed = rows.join(stored(main, "family-sizes"), "family").where("other_blocks > 0")
    in_main = F.col("component") == F.col("main")
    block = F.when(
        in_main, F.pmod(F.xxhash64("id"), F.col("main_blocks"))
    ).otherwise(F.pmod(F.xxhash64("id"), F.col("other_blocks"))).cast("int")
    # The others' blocks meet each other (row <= column) and every block of the main one.
    others = F.col("other_blocks") - 1
    row_tiles = F.transform(
        F.sequence(F.col("block"), others),
        lambda j: F.struct(F.lit(0).alias("side"), F.col("block").alias("i"), j.alias("j")),
    )
    column_tiles = F.when(
        F.col("block") > 0,
        F.transform(
            F.sequence(F.lit(0), F.col("block") - 1),
            lambda i: F.struct(F.lit(1).alias("side"), i.alias("i"), F.col("block").alias("j")),
        ),
    ).otherwise(F.array().cast("array<struct<side:int,i:int,j:int>>"))
    main_tiles = F.transform(
        F.sequence(F.lit(0), F.col("main_blocks") - 1),
        lambda j: F.struct(F.lit(0).alias("side"), F.col("block").alias("i"), (-1 - j).alias("j")),
    )
    from_main = F.transform(
        F.sequence(F.lit(0), others),
        lambda i: F.struct(F.lit(1).alias("side"), i.alias("i"), (-1 - F.col("block")).alias("j")),
    )
    tiles = (
        placed.withColumn("block", block)
        .withColumn(
            "tile",
            F.explode(
                F.when(in_main, from_main).otherwise(F.concat(row_tiles, column_tiles, main_tiles))
            ),
        )
        .select("id", "component", "family", "tile.side", "tile.i", "tile.j")
    )
    return (
        tiles.join(sets, "id")
        .groupBy("family", "i", "j")
        .applyInPandas(_tile_links(percent), "a bigint, b bigint")
    )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are runs other than ASCII white space, A-Z lower-cased; a set holds the distinct
    shingles of ``width`` words, or the whole sequence if there are fewer. Documents are
    linked if ``100 * intersection >= percent * union``; component_id is the smallest doc_id
    reachable. Null and empty texts, and texts of white space, are linked with nothing.

    A doc_id is one node: rows that repeat it share a component, whatever their texts. Rows
    without doc_id cannot be named by others: they get component_id null and stay.
    """
    texts = pick(docs, doc_id=id_column, text=text_column).withColumn(
        "doc_id", F.col("doc_id").cast("long")
    )
    signed = stored(
        texts.mapInArrow(
            _signature_rows(width),
            "doc_id bigint, words binary, n_shingles bigint, bands array<bigint>",
        ),
        "signatures",
    )
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("words").agg(F.min(F.struct("doc_id", "bands")).alias("first"))
    classes = stored(classes.select("words", "first.doc_id", "first.bands"), "text-classes")
    same = usable.join(
        classes.select("words", F.col("doc_id").alias("b")), "words"
    ).select(F.col("doc_id").alias("a"), "b")

    keyed = classes.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key"))
    hub = F.when(F.col("key") % 2 == 0, F.col("low")).otherwise(F.col("high"))
    buckets = stored(
        keyed.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
        .where("n > 1").select("key", "n", hub.alias("hub")),
        "buckets",
    )
    members = stored(keyed.join(buckets, "key"), "bucket-members")
    pairs = members.where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    ids = stored(members.select("id").distinct(), "bucket-ids")
    repeated = stored(
        usable.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
        .select(F.col("doc_id").alias("id")),
        "repeated-ids",
    )
    sets = stored(
        distinct_texts(_semi(texts, ids), repeated).mapInArrow(_set_rows(width), "id bigint, shingles array<bigint>"),
        "shingle-sets",
    )
    labels = connected_components(_confirmed(pairs, sets, percent))

    tagged = members.join(labels, "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    open_buckets = stored(
        tagged.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
        .where("x != y").select("key"),
        "open-buckets",
    )
    contested = stored(
        tagged.join(open_buckets, "key").where("n > 2").select("key", "n", "hub", "id", "component"),
        "contested",
    )
    small = contested.where((F.col("n") <= SMALL_BUCKET) & (F.col("id") != F.col("hub")))
    one = small.select("key", F.col("id").alias("a"), F.col("component").alias("x"))
    two = small.select("key", F.col("id").alias("b"), F.col("component").alias("y"))
    rest = one.join(two, "key").where("a < b AND x != y").select("a", "b").distinct()
    more = _confirmed(rest, sets, percent)
    large = contested.where(F.col("n") > SMALL_BUCKET).select("key", "id", "component")
    named = _large_bucket_links(large, sets, percent)
    first_links = labels.select(F.col("id").alias("a"), F.col("component").alias("b"))
    found = connected_components(
        first_links.unionByName(more).unionByName(named).unionByName(same)
    )

    final = found.select(F.col("id").alias("doc_id"), F.col("component").alias("component_id"))
    component = F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")
    )
    return signed.select("doc_id", "n_shingles").join(final, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
