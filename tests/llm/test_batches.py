import itertools
import math
import random
from collections import Counter, defaultdict

import pytest
from conftest import rows
from llm_fixtures import documents, edges, nothing  # noqa: F401
from pyspark.sql import functions as F

from payerlens.llm.mixing import mix_documents
from payerlens.llm.packing import optimal_boundaries, pack
from payerlens.llm.topk_search import top_products


def test_optimal_boundaries_against_all_choices():
    draw = random.Random(1)
    for _ in range(60):
        lengths = sorted(draw.sample(range(1, 40), draw.randint(1, 8)))
        counts = [draw.randint(1, 9) for _ in lengths]
        k = draw.randint(1, 4)

        def padded(bounds, lengths=lengths, counts=counts):
            return sum(c * min(b for b in bounds if b >= n) for n, c in zip(lengths, counts, strict=True))

        choices = (
            c for r in range(1, k + 1) for c in itertools.combinations(lengths, r) if c[-1] == lengths[-1]
        )
        assert padded(optimal_boundaries(lengths, counts, k)) == min(map(padded, choices))
    assert optimal_boundaries([], [], 3) == []


def test_pack(edges, nothing):
    found = rows(pack(edges, max_length=100, buckets=3, token_budget=300))
    spans = defaultdict(list)
    for r in found:
        spans[r["doc_id"]].append((r["token_start"], r["length"]))
        assert (r["batch"] is None) == (r["length"] == 0)
        assert r["length"] == 0 or r["length"] <= r["padded_length"] <= 100
    assert sorted(spans[7]) == [(s, 100) for s in range(0, 60_000, 100)]
    assert spans[1] == [(0, 0)] and spans[4] == [(0, 1), (0, 1)]
    batches = defaultdict(list)
    for r in found:
        if r["batch"] is not None:
            batches[r["bucket"], r["batch"]].append((r["slot"], r["padded_length"]))
    for slots in batches.values():
        assert sorted(s for s, _ in slots) == list(range(len(slots)))
        assert sum(p for _, p in slots) <= 300
    assert pack(nothing).count() == 0


def test_mixing_budgets(documents, nothing, edges):
    """a is short of its half: b and c share the shortage, then the other domain does."""
    made = [(n, "w " * 10, "en", "xa") for n in range(5)]
    made += [(100 + n, "w " * 10, "en", "xb") for n in range(50)]
    made += [(200 + n, "w " * 10, "en", "xc") for n in range(50)]
    made += [(300 + n, "w " * 10, "en", "ya") for n in range(400)]
    docs = documents(*made)
    # 5050 tokens, 60 %: 3030. Domains x and y get 1515 each; x can give 1050 only.
    found = mix_documents(docs, budget_percent=60, max_epochs=1, weights={})
    taken = {r["source_name"]: r["t"] for r in rows(found.groupBy("source_name").agg(F.sum("tokens").alias("t")))}
    assert taken == {"xa": 50, "xb": 500, "xc": 500, "ya": 1980}
    # 30 %: 757 each (1515 * 1 div 2); xa takes its 50, xb and xc share 707.
    found = mix_documents(docs, budget_percent=30, max_epochs=1, weights={})
    taken = {r["source_name"]: r["t"] for r in rows(found.groupBy("source_name").agg(F.sum("tokens").alias("t")))}
    assert taken == {"xa": 50, "xb": 350, "xc": 350, "ya": 750}
    twice = rows(mix_documents(docs, budget_percent=100, max_epochs=3, weights={"domain": {"x": 9}}))
    epochs = Counter((r["source_name"], r["epoch"]) for r in twice)
    assert epochs["xa", 0] == epochs["xa", 1] == epochs["xa", 2] == 5
    kept = mix_documents(docs, budget_percent=100, max_epochs=1, weights={}, keep=["doc_id", "tokens", "text"])
    assert kept.columns == ["doc_id", "tokens", "text"] and kept.count() == 505
    assert mix_documents(nothing).count() == 0
    whole = mix_documents(edges, budget_percent=100, max_epochs=1, weights={})
    assert {r["doc_id"] for r in rows(whole)} >= {4, 5, 6, 7, 8, 9, 10, 11, None}


def test_mixing_does_not_depend_on_the_order_of_rows(documents):
    """Rows without doc_id and rows that repeat one have their place by their texts."""
    made = [(None, f"w{n} x y") for n in range(40)] + [(7, f"v{n} x y") for n in range(40)]
    docs = documents(*made)
    picks = [
        Counter(r["text"] for r in rows(mix_documents(d, budget_percent=50, keep=["text"])))
        for d in (docs.coalesce(1), docs.orderBy(F.desc("text")).coalesce(1), docs.repartition(7, "text"))
    ]
    assert picks[0] == picks[1] == picks[2] and 39 <= picks[0].total() <= 40


def brute_top(vectors, k):
    out = set()
    usable = {
        (i, tuple(math.floor(256 * x) for x in v))
        for i, v in vectors
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }
    for i, q in usable:
        if i % 50 == 0:
            scored = sorted(
                (-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in usable if j != i and len(v) == len(q)
            )
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("unit", [True, False])
def test_top_products(spark, unit):
    draw = random.Random(unit)
    vectors = []
    for i in range(700):
        v = [draw.gauss(0, 1) for _ in range(8)]
        size = math.sqrt(sum(x * x for x in v)) if unit else draw.choice([0.5, 1, 5])
        vectors.append((i, [x / size for x in v]))
    vectors += [(1000 + i, [0.5] * 8) for i in range(80)]  # equal vectors: ties
    vectors += [(2000, [1.0, 2.0]), (2001, [1.0, 3.0]), (2050, None), (2100, [1.0, None]), (2150, [float("nan")] * 8)]
    vectors += [(2200, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (2250, []), (2300, [0.0] * 8), (50, vectors[50][1])]
    frame = spark.createDataFrame(
        [(i, v, "x", 1) for i, v in vectors], "vec_id bigint, embedding array<double>, width string, bucket int"
    )
    found = top_products(frame, F.col("vec_id") % 50 == 0, bucket_rows=64, query_rows=5)
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == brute_top(vectors, 5)
    assert top_products(frame.where("vec_id < 0"), F.col("vec_id") % 50 == 0).count() == 0
