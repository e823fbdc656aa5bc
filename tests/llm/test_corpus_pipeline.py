"""The pipeline against brute force, stage by stage, each on its predecessor's rows."""

import re
from collections import Counter

import duckdb
import pyarrow as pa
from conftest import TABLES
from test_dedup import brute_lines, brute_near

import corpus_pipeline
from check_queries import compare, open_oracle
from payerlens.llm.queries import LLM_QUERIES, LLM_SQL
from payerlens.llm.tables import read_table, stored


def rows_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_stages(spark):
    docs, inputs = read_table(spark, TABLES, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        docs = stored(stage(spark, docs, TABLES), f"test-{name}")
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    start, good, lines, unique, mixed = inputs

    labels = {r["doc_id"]: r["quality"] for r in read_table(spark, TABLES, "labels").collect()}
    kept = {i for i, _ in rows_of(good)}
    assert {i for i, q in labels.items() if q == 1} <= kept
    assert len([i for i, q in labels.items() if q == 0 and i in kept]) <= 2

    cleaned = brute_lines(rows_of(good))
    expected = Counter(
        (i, text) for (i, t), (text, _, gone) in cleaned.items()
        if not gone or re.search(r"[^\x20\x09-\x0d]", text)
    )
    assert Counter(rows_of(lines)) == expected

    near = brute_near(rows_of(lines), 5, 80)
    gone = {i for i, _, _, stays in near if not stays}
    assert Counter(rows_of(unique)) == Counter((i, t) for i, t in rows_of(lines) if i not in gone)

    connection = duckdb.connect()
    connection.register("documents", pa.table(unique.toArrow()))
    picked = connection.sql(f"SELECT doc_id, count(*) FROM ({LLM_SQL['op6_mixing']}) GROUP BY 1").fetchall()
    assert Counter(i for i, _ in rows_of(mixed)) == Counter(dict(picked))
    texts = dict(rows_of(unique))
    assert all(texts[i] == t for i, t in rows_of(mixed))

    connection = duckdb.connect()
    connection.register("documents", pa.table(mixed.toArrow()))
    assert compare(docs, connection.sql(LLM_SQL["op5_packing"])) is None
    assert compare(corpus_pipeline.run(spark, TABLES), connection.sql(LLM_SQL["op5_packing"])) is None
    assert len(rows_of(start)) >= len(kept)


def test_queries_equal_sql(spark):
    oracle = open_oracle(TABLES)
    for name, sql in LLM_SQL.items():
        assert compare(LLM_QUERIES[name](spark, TABLES), oracle.sql(sql)) is None, name
    assert set(LLM_SQL) < set(LLM_QUERIES) and len(LLM_QUERIES) == 14
