"""Filter interaction audit on a sparse document-term matrix.

Words are encoded by one dictionary for the whole corpus: the code of a word is a 64-bit hash,
and the dictionary, one aggregation of the distinct words of all texts, proves that no two
words share a code or names those that do; they get codes of their own. So tasks encode their
texts alone and no token is shuffled. Each task builds compressed sparse row (CSR) shards: one
matrix row a document, one stored value a distinct word. Row sums (words) and counts of
stored values (distinct words) decide filters A and B. C and D look at the characters,
E at texts that occur with a smaller doc_id anywhere in the table.

What each order of the filters removes follows from the 32 combinations of failed filters:
documents are counted by part, combination and labels, and these few counts give every row.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payerlens.llm.samples import rows_in_blocks
from payerlens.llm.tables import pick, stored
from payerlens.llm.textbytes import IS_SPACE, class_counts, column_bytes, small_batches, words

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITAL_PERCENT = 3
MARKS = "#$%&*|"
MOST_AMBIGUOUS = 100_000  # codes that several words share; beyond it every word is compared as text
_CODES = np.arange(256)
_CLASSES = [
    (_CODES >= ord("A")) & (_CODES <= ord("Z")),
    np.isin(_CODES, [ord(c) for c in MARKS]),
    (_CODES >= 0x80) & (_CODES < 0xC0),  # all but the first byte of a code point
]
_ALL = len(FILTERS)
_COMPARED = 1 << 20  # bytes of words that are compared at once


class Shard(NamedTuple):
    """CSR rows of a block of documents: ``codes`` are the columns, ``counts`` the values."""

    indptr: np.ndarray
    codes: np.ndarray
    counts: np.ndarray

    def row_sums(self) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(self.counts)])
        return total[self.indptr[1:]] - total[self.indptr[:-1]]

    def stored_values(self) -> np.ndarray:
        return np.diff(self.indptr)


class Coder(NamedTuple):
    """Codes of words: their hashes, but for hashes that several words share.

    ``own`` gives each word of such a hash a code of its own. Without it (None) too many
    hashes are shared, and a block numbers its words by their text instead.
    """

    shared: np.ndarray
    own: dict[bytes, int] | None

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The code of every word of a block, and the word offsets of its rows."""
        hashes, sizes, bounds = words(raw, offsets, lower=False)
        if self.own is None:
            seen: dict[bytes, int] = {}
            texts = _texts(raw, offsets, sizes, np.arange(len(hashes)))
            return np.array([seen.setdefault(t, len(seen)) for t in texts], np.uint64), bounds
        at = np.flatnonzero(np.isin(hashes, self.shared)) if len(self.shared) else self.shared
        if len(at):
            hashes = hashes.copy()
            hashes[at] = [self.own[t] for t in _texts(raw, offsets, sizes, at)]
        return hashes, bounds

    def shard(self, raw: np.ndarray, offsets: np.ndarray) -> Shard:
        codes, bounds = self.encode(raw, offsets)
        used, place = np.unique(codes, return_inverse=True)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        cell, counts = np.unique(row * max(len(used), 1) + place, return_counts=True)
        row_of = cell // max(len(used), 1)
        return Shard(np.searchsorted(row_of, np.arange(len(offsets))), used[cell - row_of * max(len(used), 1)], counts)


def _starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each word begins, in the order of ``words``."""
    begins = ~IS_SPACE[raw]
    inside = begins.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = inside[first]
    return np.flatnonzero(begins)


def _texts(raw: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> list[bytes]:
    """The bytes of the words numbered ``at``."""
    starts, data = _starts(raw, offsets)[at], raw.tobytes()
    return [data[s : s + n] for s, n in zip(starts.tolist(), sizes[at].tolist(), strict=True)]


def _differing(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Numbers of the words that are not, byte for byte, the word numbered in ``first``."""
    same_size = np.flatnonzero(sizes == sizes[first])
    out = [np.flatnonzero(sizes != sizes[first])]
    upto = np.concatenate([[0], np.cumsum(sizes[same_size])])
    for start, end in rows_in_blocks(upto, _COMPARED):  # what is allocated follows the step, not the text
        part = same_size[start:end]
        length, ends = sizes[part], upto[start + 1 : end + 1] - upto[start]
        inside = np.arange(ends[-1]) - np.repeat(ends - length, length)
        unequal = raw[np.repeat(starts[part], length) + inside] != raw[np.repeat(starts[first[part]], length) + inside]
        out.append(part[np.unique(np.searchsorted(ends, np.flatnonzero(unequal), "right"))])
    return np.concatenate(out)


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One word of each hash of a block, and all words that differ from that one."""
    for batch in small_batches(batches):
        raw, offsets = column_bytes(batch.column("text"))
        hashes, sizes, _ = words(raw, offsets, lower=False)
        _, at, place = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.concatenate([at, _differing(raw, _starts(raw, offsets), sizes, at[place])]) if len(at) else at
        texts = pa.array(_texts(raw, offsets, sizes, at), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(hashes[at].view(np.int64)), texts], ["hash", "word"])


def dictionary(texts: DataFrame) -> DataFrame:
    """(hash, word) of every distinct word of ``texts(text)``, stored."""
    found = texts.mapInArrow(_distinct_words, "hash bigint, word binary")
    return stored(found.distinct(), "dictionary")


def coder(entries: DataFrame, most_ambiguous: int = MOST_AMBIGUOUS) -> Coder:
    """The coder of a dictionary. Words that share a hash get codes that no hash has."""
    several = entries.groupBy("hash").count().where("count > 1").select("hash")
    shared = stored(several, "shared-hashes")
    if shared.count() > most_ambiguous:
        return Coder(np.zeros(0, np.uint64), None)
    rows = sorted((r["hash"], bytes(r["word"])) for r in entries.join(shared, "hash").collect()) if shared.count() else []
    if not rows:
        return Coder(np.zeros(0, np.uint64), {})
    wanted, free = len(rows), []
    while len(free) < wanted:  # numbers from 0 that are no word's hash
        first = free[-1] + 1 if free else 0
        block = entries.sparkSession.range(first, first + 4 * wanted).select(F.col("id").alias("hash"))
        free += sorted(r[0] for r in block.join(entries, "hash", "left_anti").collect())
    hashes = np.unique(np.array([h for h, _ in rows], np.int64)).view(np.uint64)
    return Coder(hashes, {word: code for (_, word), code in zip(rows, free[:wanted], strict=True)})


def csr_shards(texts: DataFrame, codes: Coder) -> DataFrame:
    """The matrix of ``texts(doc_id, text)``: one row a shard, with the arrays as bytes.

    doc_ids (array), indptr (int64), codes (uint64) and counts (int64), little-endian.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            shard = codes.shard(*column_bytes(batch.column("text")))
            ids = pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64()))
            arrays = [pa.array([a.tobytes()], pa.binary()) for a in shard]
            yield pa.RecordBatch.from_arrays([ids, *arrays], ["doc_ids", "indptr", "codes", "counts"])

    return texts.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        rows, "doc_ids array<bigint>, indptr binary, codes binary, counts binary"
    )


def _failed(codes: Coder) -> Callable:
    """A to D of every document as bits, from its CSR row and its characters."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            raw, offsets = column_bytes(batch.column("text"))
            shard = codes.shard(raw, offsets)
            n, distinct = shard.row_sums(), shard.stored_values()
            capitals, marks, inner = class_counts(raw, offsets, _CLASSES).T
            points = np.diff(offsets) - inner
            mask = (
                (n < LEAST_WORDS) * 1
                + (100 * distinct < LEAST_DISTINCT_PERCENT * n) * 2
                + (100 * capitals > MOST_CAPITAL_PERCENT * points) * 4
                + (marks > 0) * 8
            )
            names = ["doc_id", "part", "digest"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(mask.astype(np.int32))], [*names, "mask"]
            )

    return rows


def _with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``good`` and ``toxic`` of each row; rows without doc_id have no label and move nowhere."""
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    named = rows.where("doc_id IS NOT NULL").join(known, "doc_id", "left").fillna(False, ["good", "toxic"])
    none = rows.where("doc_id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    return named.unionByName(none)


def failure_counts(rows: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by failed filters, E among them.

    A text that a third of all documents have is counted by doc_id first, then by
    what its copies have in common; no task gets all its rows.
    """
    kind = ["digest", "part", "mask", "good", "toxic"]
    each = rows.groupBy(*kind, "doc_id").agg(F.count("*").alias("c"))
    unnamed = F.sum(F.when(F.col("doc_id").isNull(), F.col("c")).otherwise(0))
    groups = each.groupBy(*kind).agg(
        F.sum("c").alias("n"),
        unnamed.alias("unnamed"),
        F.min("doc_id").alias("least"),
        F.min_by("c", "doc_id").alias("at_least"),
    )
    first = F.min("least").over(Window.partitionBy("digest"))
    passing = F.col("unnamed") + F.when(F.col("least") == first, F.col("at_least")).otherwise(0)
    split = groups.withColumn("passing", passing).select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("mask").alias("mask"), F.col("passing").alias("n")),
            F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("passing")).alias("n")),
        )),
    )
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def _steps() -> str:
    """All orders and steps: the step's filter and the filters before it as bits."""
    out = []
    for order in map("".join, permutations(FILTERS)):
        bits = [1 << FILTERS.index(c) for c in order]
        out += [{"o": order, "s": i + 1, "f": bits[i], "p": sum(bits[:i])} for i in range(_ALL)]
    return json.dumps(out)


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from (part, mask, n, good, toxic)."""
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    steps = F.from_json(F.lit(_steps()), "array<struct<o:string,s:int,f:int,p:int>>")
    f, before = F.col("at.f"), F.col("at.p")

    def total(value: str, condition: Callable) -> F.Column:
        return F.aggregate(
            F.filter("cells", condition), F.lit(0).cast("long"), lambda a, x: a + x[value].cast("long")
        )

    fails = lambda x: x["mask"].bitwiseAND(f) != 0
    earlier = lambda x: x["mask"].bitwiseAND(before) != 0
    # A document that fails k filters is removed by each of them in a k-th of all orders.
    share = lambda x: x["n"].cast("long") * (F.lit(120) / F.bit_count(x["mask"])).cast("long")
    return cells.withColumn("at", F.explode(steps)).select(
        "part",
        F.col("at.o").alias("filter_order"),
        F.col("at.s").alias("step"),
        total("n", lambda x: ~fails(x) & ~earlier(x)).alias("kept"),
        total("n", lambda x: fails(x) & ~earlier(x)).alias("removed"),
        total("n", lambda x: fails(x) & earlier(x)).alias("redundant"),
        total("n", lambda x: x["mask"] == f).alias("unique_fails"),
        total("good", lambda x: fails(x) & ~earlier(x)).alias("good_lost"),
        total("toxic", lambda x: fails(x) & ~earlier(x)).alias("toxic_lost"),
        F.aggregate(F.filter("cells", fails), F.lit(0).cast("long"), lambda a, x: a + share(x)).alias("shapley"),
    )


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "lang",
    most_ambiguous: int = MOST_AMBIGUOUS,
) -> DataFrame:
    """How five filters interact: one row per part, order of the filters and step, zeros included.

    ``labels(doc_id, quality, toxic)``: several rows of a doc_id count if any has a 1. A null
    text is empty, a null part is the empty string. An empty text fails A only (and E, if
    a smaller doc_id is empty too). Rows that repeat doc_id and text are documents of their
    own, none of which fails E because of the other. A row without doc_id has no label, does
    not fail E and makes no other row fail it. Without documents the result is empty.
    """
    slim = pick(docs, doc_id=id_column, text=text_column, part=part_column).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"),
    )
    codes = coder(dictionary(slim.select("text")), most_ambiguous)
    digested = slim.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    schema = "doc_id bigint, part string, digest binary, mask int"
    flags = stored(digested.mapInArrow(_failed(codes), schema), "filter-flags")
    known = pick(labels, doc_id="doc_id", quality="quality", toxic="toxic").withColumn("doc_id", F.col("doc_id").cast("long"))
    return interactions(failure_counts(_with_labels(flags, known)))
