"""Exact deduplication by content-defined chunk recipes.

Every text is cut where a rolling hash of its last 32 bytes says so, which makes the
cuts a function of the text alone. A chunk is named by a 64-bit digest. The names are
verified on the chunks themselves: chunks are deduplicated by (digest, bytes), each
moving once, and a digest that stands for two different chunks is a collision. A
document is then only its ordered list of names; equal lists are equal texts. Documents
whose list holds a collided name are told apart by their SHA-256 as well.

What moves: each distinct chunk of a task once, then lists of 8 bytes a chunk. Copies of
a chunk or of a list are combined before the shuffle, so a text that a third of all
documents share is one row per task.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payerlens.llm.tables import pick, stored
from payerlens.llm.textbytes import BYTE_CODES, SEGMENT_BYTES, column_bytes

_WINDOW = 32
_GEAR = (BYTE_CODES >> np.uint64(32)).astype(np.uint32)
# Chunks of 512 bytes to 16 KB, about 2 KB in the mean. The least is above the hash
# window, so no cut depends on the text before.
LEAST, MOST, MASK = 512, 16384, np.uint32(0x7FF << 21)


def chunk_digest(chunk) -> int:
    """The 64-bit name of a chunk, signed as Spark's long."""
    value = xxhash.xxh3_64_intdigest(chunk)
    return value - (1 << 64) if value >> 63 else value


def _cut_places(raw: np.ndarray) -> list[int]:
    """Positions after which a chunk may end: the rolling hash has zeros under the mask."""
    found = []
    for start in range(0, len(raw), SEGMENT_BYTES):
        lead = max(0, start - _WINDOW + 1)
        rolling = _GEAR[raw[lead : start + SEGMENT_BYTES]]
        for shift in (1, 2, 4, 8, 16):  # doubles the covered window each time
            rolling[shift:] = rolling[shift:] + (rolling[:-shift] << np.uint32(shift))
        places = np.flatnonzero((rolling & MASK) == 0) + lead
        found.append(places[places >= start])
    return np.concatenate(found).tolist() if found else []


def chunk_ends(raw: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """For each row the ends of its chunks; none for an empty text."""
    places = _cut_places(raw)
    rows, bounds = [], offsets.tolist()
    for start, end in zip(bounds, bounds[1:], strict=False):
        ends = []
        while end - start > LEAST:
            at = bisect_left(places, start + LEAST - 1)
            cut = places[at] + 1 if at < len(places) else end
            start = min(cut, start + MOST, end)
            ends.append(start)
        if start < end:
            ends.append(end)
        rows.append(ends)
    return rows


def _chunks(batch: pa.RecordBatch, digest) -> tuple[np.ndarray, np.ndarray, list[list[int]], list[int]]:
    raw, offsets = column_bytes(batch.column("text"))
    ends = chunk_ends(raw, offsets)
    bounds = np.array([0, *(e for row in ends for e in row)], np.int64)
    view = memoryview(np.ascontiguousarray(raw))
    names = [digest(view[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return raw, bounds, ends, names


def _chunk_rows(digest) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds, _, names = _chunks(batch, digest)
            chunks = pa.Array.from_buffers(
                pa.large_binary(), len(names), [None, pa.py_buffer(bounds), pa.py_buffer(raw.tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), chunks.cast(pa.binary())], ["digest", "chunk"]
            )

    return rows


def _recipe_rows(digest) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, _, ends, names = _chunks(batch, digest)
            offsets = np.cumsum([0, *map(len, ends)]).astype(np.int32)
            _, bounds = column_bytes(batch.column("text"))
            view, bounds = memoryview(np.ascontiguousarray(raw)), bounds.tolist()
            whole = [
                hashlib.sha256(view[a:b]).hexdigest()
                for a, b in zip(bounds[:-1], bounds[1:], strict=True)
            ]
            recipes = pa.ListArray.from_arrays(pa.array(offsets), pa.array(names, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), recipes, pa.array(whole, pa.string())],
                ["doc_id", "recipe", "text_sha256"],
            )

    return rows


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Callable = chunk_digest,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. The largest doc_id of equal
    texts stays (nulls come last). Of rows that repeat doc_id and text exactly one stays.
    A group without any doc_id has keep_id null and one kept row. Other columns of
    ``docs`` are not read.
    """
    texts = pick(docs, doc_id=id_column, text=text_column)
    texts = texts.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    recipes = stored(
        texts.mapInArrow(
            _recipe_rows(digest), f"doc_id {id_type}, recipe array<bigint>, text_sha256 string"
        ),
        "chunk-recipes",
    )
    chunks = texts.select("text").mapInArrow(_chunk_rows(digest), "digest bigint, chunk binary")
    collided = stored(
        chunks.groupBy("digest", "chunk").agg(F.count("*").alias("n"))
        .groupBy("digest").agg(F.count("*").alias("contents"))
        .where("contents > 1").select("digest"),
        "collided-chunks",
    )
    unsure = (
        recipes.select("recipe", F.explode(F.array_distinct("recipe")).alias("digest"))
        .join(collided, "digest", "left_semi")
        .select("recipe").distinct().withColumn("unsure", F.lit(True))
    )
    proof = F.when(F.col("unsure"), F.col("text_sha256")).otherwise("")
    texts_of = ["recipe", "proof"]
    ids = stored(
        recipes.join(stored(unsure, "unsure-recipes"), "recipe", "left")
        .groupBy("doc_id", "recipe", proof.alias("proof"))
        .agg(F.count("*").alias("copies"), F.max("text_sha256").alias("text_sha256")),
        "recipe-ids",
    )
    groups = stored(
        ids.groupBy(*texts_of).agg(
            F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
        ),
        "recipe-groups",
    )
    each = ids.join(groups, texts_of).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    )
    return each.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )
