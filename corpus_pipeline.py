"""The corpus pipeline: documents in, packed training batches out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payerlens.llm.line_dedup import dedup_lines
from payerlens.llm.mixing import mix_documents
from payerlens.llm.near_dedup import near_duplicates
from payerlens.llm.packing import pack
from payerlens.llm.quality import classify_quality
from payerlens.llm.tables import read_table, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return classify_quality(docs, keep=COLUMNS).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go; documents left without words go as well."""
    cleaned = dedup_lines(docs).where("removed_lines = 0 OR text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'")
    length = F.when(F.col("removed_lines") > 0, F.length("text").cast("long"))
    return cleaned.withColumn("n_chars", F.coalesce(length, F.col("n_chars").cast("long"))).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays: the smallest doc_id, then the smallest hash of the text.

    Rows get numbers of their own, by which they are compared: rows that repeat doc_id and text, and copies
    without doc_id, are copies like any other, and two texts that share a doc_id are two documents. Rows
    without doc_id stay only if no other of their group has one. Texts without words are near to
    nothing; of those, rows that agree in doc_id and text are one.
    """
    numbered = stored(docs.select(*COLUMNS).withColumn("node", F.monotonically_increasing_id()), "numbered-documents")
    found = near_duplicates(numbered, id_column="node").select(
        F.col("doc_id").alias("node"), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("component")
    )
    # Only narrow rows move: the text counts by its hash.
    thin = numbered.select("node", "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    wordless = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), "digest")
    grouped = stored(
        thin.join(found, "node").withColumn("group", F.coalesce(F.col("component").cast("string"), wordless)), "near-groups"
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "digest", "node")
    stays = grouped.groupBy("group").agg(F.min(order)["node"].alias("node"))
    gone = stored(grouped.select("node").join(stays, "node", "left_anti"), "near-copies")
    return numbered.join(gone, "node", "left_anti").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Target weights by language and source; a document comes once for each epoch."""
    return mix_documents(docs, keep=COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches; the spans of the pieces, not their texts."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# The first stage fits a model, which SQL can't express; see tests/llm/test_corpus_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is stored for the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
