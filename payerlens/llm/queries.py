"""The registered queries of the operators: each takes a session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from payerlens.llm.exact_dedup import exact_dedup
from payerlens.llm.filter_audit import audit_filters
from payerlens.llm.html_extract import extract_main_text
from payerlens.llm.language_id import identify_languages
from payerlens.llm.line_dedup import dedup_lines
from payerlens.llm.mixing import mix_documents
from payerlens.llm.near_dedup import near_duplicates
from payerlens.llm.packing import pack
from payerlens.llm.prefix_trie import prefix_trie
from payerlens.llm.quality import classify_quality
from payerlens.llm.secret_scan import scan_secrets
from payerlens.llm.sql import LLM_SQL
from payerlens.llm.tables import read_table
from payerlens.llm.topk_search import top_products
from payerlens.llm.toxicity import score_toxicity

__all__ = ["LLM_QUERIES", "LLM_SQL"]
Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(read_table(spark, sf_dir, "documents"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(read_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(read_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "line_count", "removed_lines")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), width=4, percent=80)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return identify_languages(read_table(spark, sf_dir, "documents"), held_out)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), held_out)


LLM_QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_quality_classifier,
        op2_exact_topk,
        op3_exact_dedup,
        op4_secret_scan,
        op5_packing,
        op6_mixing,
        op7_line_dedup,
        op8_near_dedup,
        op9_language_id,
        op10_html_extraction,
        op11_filter_audit,
        op12_prefix_trie,
        op13_toxicity,
    )
} | {"pipeline": corpus_pipeline.run}
