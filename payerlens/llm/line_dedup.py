"""Line deduplication by overlapping windows of three lines, in Spark built-ins.

Every run of three consecutive lines is a window, named by two 64-bit hashes. Windows that
occur more than once, anywhere, are found by one grouping. The first occurrence (by
doc_id, then position) stays; of every later one the three covered lines go. Overlapping and
adjacent windows merge into ranges, and a text is rebuilt from what lies between them.

A window that a third of all documents share is counted with map-side combine and joined by
an equi-join against a stored table, which the adaptive skew join splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payerlens.llm.tables import stored

WINDOW_LINES = 3
_SECOND_SEED = 0x5EED
_KEY = ["doc_id", "code", "code2"]  # of a document: ids may be missing or repeat


def _codes(text: Column) -> list[Column]:
    """Two 64-bit hashes of a text; 0 for null."""
    hashes = (F.xxhash64(text), F.xxhash64(F.lit(_SECOND_SEED), text))
    return [F.when(text.isNull(), 0).otherwise(h).cast("long") for h in hashes]


def _windows(docs: DataFrame) -> DataFrame:
    """(doc_id, code, code2, position, h1, h2): position counts lines from 0."""
    lines = F.split("text", "\n", -1)
    hashes = F.transform(
        lines,
        lambda line: F.struct(
            F.xxhash64(line).alias("x"), F.xxhash64(F.lit(_SECOND_SEED), line).alias("y")
        ),
    )
    hashed = docs.select(*_KEY, hashes.alias("lines")).where(F.size("lines") >= WINDOW_LINES)
    each = F.transform(
        F.sequence(F.lit(1), F.size("lines") - WINDOW_LINES + 1),
        lambda i: F.struct(
            (i - 1).alias("position"),
            F.xxhash64(*[F.element_at("lines", i + k)["x"] for k in range(WINDOW_LINES)]).alias("h1"),
            F.xxhash64(*[F.element_at("lines", i + k)["y"] for k in range(WINDOW_LINES)]).alias("h2"),
        ),
    )
    return hashed.select(*_KEY, F.inline(each))


def removed_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, code, code2, ranges) of the texts that lose lines; ranges are [first, last] from 0."""
    # doc_id (missing ones first), then the text's hashes, then position: a total order of all windows.
    windows = _windows(docs).withColumn("place", F.struct(F.col("doc_id").isNotNull(), *_KEY, "position"))
    repeated = stored(
        windows.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min("place").alias("kept_place"))
        .where("n > 1").drop("n"),
        "repeated-windows",
    )
    later = (
        windows.join(repeated, ["h1", "h2"]).where(F.col("place") > F.col("kept_place"))
        .select(*_KEY, "position").distinct()
    )
    in_order = Window.partitionBy(*_KEY).orderBy("position")
    gap = F.col("position") > F.lag("position").over(in_order) + WINDOW_LINES
    return (
        later.withColumn("starts", F.when(gap, 1).otherwise(0))
        .withColumn("run", F.sum("starts").over(in_order))
        .groupBy(*_KEY, "run")
        .agg(
            F.min("position").alias("first"),
            (F.max("position") + WINDOW_LINES - 1).alias("last"),
        )
        .groupBy(*_KEY)
        .agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("ranges"))
    )


def dedup_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with its text cleaned, plus line_count, removed_lines and removed_ranges.

    Lines are what lies between newlines. A text of fewer than three lines has no window and
    is left alone. Null stays null and has no lines; an empty text has one. A text may become
    empty. Rows that repeat doc_id and text are one document: they get the same result.
    Documents without doc_id come first in the order, by 128 bits of hash of their text, which also
    tell them apart.

    The added columns replace input columns of the same name.
    """
    text, added = F.col(f"`{text_column}`").cast("string"), ["line_count", "removed_lines", "removed_ranges"]
    code, code2 = _codes(text)
    slim = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), text.alias("text"), code.alias("code"), code2.alias("code2")
    )
    ranges = stored(removed_ranges(slim), "removed-ranges").select(
        F.col("doc_id").alias("_line_id"),
        F.col("code").alias("_line_code"),
        F.col("code2").alias("_line_code2"),
        F.col("ranges").alias("removed_ranges"),
    )
    own = [c for c in docs.columns if c not in added]
    # Numbered names, so that no input column clashes with the ranges.
    base = docs.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(own)])
    text = F.col(f"in_{own.index(text_column)}")
    doc_id = F.col(f"in_{own.index(id_column)}").cast("long")
    code, code2 = _codes(text)
    # Always a merge join: texts move once at every size, whether the ranges are few or many.
    joined = base.join(
        ranges.hint("merge"),
        (code == F.col("_line_code")) & (code2 == F.col("_line_code2")) & doc_id.eqNullSafe(F.col("_line_id")),
        "left",
    )
    lines = F.split(text, "\n", -1)
    count, found = F.size("removed_ranges"), F.col("removed_ranges")
    kept = F.flatten(
        F.transform(
            F.sequence(F.lit(0), count),
            lambda i: F.slice(
                lines,
                F.when(i == 0, F.lit(1)).otherwise(F.get(found, i - 1)["last"] + 2),
                F.when(i == count, F.size(lines)).otherwise(F.get(found, i)["first"])
                - F.when(i == 0, F.lit(0)).otherwise(F.get(found, i - 1)["last"] + 1),
            ),
        )
    )
    cleaned = F.when(found.isNull(), text).otherwise(F.array_join(kept, "\n"))
    gone = F.aggregate(found, F.lit(0), lambda total, r: total + r["last"] - r["first"] + 1)
    return joined.select(
        *[
            (cleaned if c == text_column else F.col(f"in_{i}")).alias(c) for i, c in enumerate(own)
        ],
        F.coalesce(F.size(lines), F.lit(0)).alias("line_count"),
        F.coalesce(gone, F.lit(0)).alias("removed_lines"),
        F.coalesce(found, F.array().cast("array<struct<first:int,last:int>>")).alias("removed_ranges"),
    )
