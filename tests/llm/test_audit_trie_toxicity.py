"""Filter audit, prefix trie and toxicity against brute force and held-out labels."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from conftest import by
from llm_fixtures import documents, edges, nothing  # noqa: F401
from pyspark.sql import functions as F

from payerlens.llm import filter_audit as audit
from payerlens.llm import prefix_trie as trie
from payerlens.llm import textbytes, toxicity
from payerlens.llm.filter_audit import audit_filters, coder, csr_shards, dictionary
from payerlens.llm.prefix_trie import prefix_trie
from payerlens.llm.queries import op13_toxicity
from payerlens.llm.tables import read_table
from payerlens.llm.toxicity import Automaton, Term, context_factor, edits_of, score_toxicity, tokens

TABLES = "/root/testdata/sf0.01"
WORD = r"[^\x20\x09-\x0d]+"


# --- filter audit ------------------------------------------------------------------------


def brute_audit(docs, labels):
    least = {}
    for i, t, *_ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    known = defaultdict(lambda: [0, 0])
    for i, quality, toxic in labels:
        known[i] = [known[i][0] or quality == 1, known[i][1] or toxic == 1]
    rows = defaultdict(list)
    for i, t, lang, *_ in docs:
        t = t or ""
        w = re.findall(WORD, t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t],
        }
        good, toxic = known[i] if i is not None else (0, 0)
        rows[lang or ""].append(({k for k, v in fails.items() if v}, good, toxic))
    out = {}
    for part, kinds in rows.items():
        lost = Counter()
        for order in permutations("ABCDE"):
            for fails, _, _ in kinds:
                lost[next((c for c in order if c in fails), None)] += 1
        for order in map("".join, permutations("ABCDE")):
            for s, c in enumerate(order, 1):
                before = set(order[: s - 1])
                here = [k for k in kinds if c in k[0] and not k[0] & before]
                out[part, order, s] = (
                    sum(not k[0] & (before | {c}) for k in kinds), len(here), sum(c in k[0] and bool(k[0] & before) for k in kinds),
                    sum(k[0] == {c} for k in kinds), sum(bool(k[1]) for k in here), sum(bool(k[2]) for k in here), lost[c],
                )
    return out


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit_rows(frame):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COUNTS) for r in frame.collect()}


@pytest.fixture(scope="module")
def audited(spark, documents):  # noqa: F811
    draw = random.Random(2)
    texts = [" ".join(draw.choice(["alpha", "Beta", "γάμμα", "x#", "BIG", f"w{draw.randint(0, 900)}"]) for _ in range(draw.choice([3, 150, 260, 700]))) for _ in range(40)]
    rows = [(draw.choice([None, *range(60)]), draw.choice([*texts, None, "", " \t"]), draw.choice(["en", "de", None, ""])) for _ in range(150)]
    labels = [(draw.choice([None, *range(60)]), draw.choice([0, 1, None]), draw.choice([0, 1, None])) for _ in range(80)]
    return rows, labels, documents(*rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_audit_against_brute_force(audited):
    rows, labels, docs, known = audited
    assert audit_rows(audit_filters(docs, known)) == brute_audit(rows, labels)


@pytest.mark.parametrize("most", [audit.MOST_AMBIGUOUS, 0])
def test_words_that_share_a_hash_stay_apart(audited, monkeypatch, spark, most):
    """Hashes cut to eight values: the dictionary finds the shared ones, and counts stay exact."""
    rows, labels, docs, known = audited
    real = textbytes.words

    def colliding(raw, offsets, lower=True):
        hashes, sizes, bounds = real(raw, offsets, lower)
        return hashes % np.uint64(8), sizes, bounds

    # Tasks import the module by name, so they are given the forced hash as well.
    real_failed, real_distinct = audit._failed, audit._distinct_words

    def distinct(batches):
        audit.words = colliding
        try:
            yield from real_distinct(batches)
        finally:
            audit.words = real

    def failed(codes):
        inner = real_failed(codes)

        def rows_(batches):
            audit.words = colliding
            try:
                yield from inner(batches)
            finally:
                audit.words = real

        return rows_

    monkeypatch.setattr(audit, "words", colliding)
    monkeypatch.setattr(audit, "_distinct_words", distinct)
    monkeypatch.setattr(audit, "_failed", failed)
    entries = dictionary(docs.select("text"))
    assert entries.select("hash").distinct().count() == 8 < entries.count()
    made = coder(entries, most)
    assert (made.own is None) is (most == 0)
    if most:
        shared = entries.groupBy("hash").count().where("count > 1").agg(F.sum("count")).first()[0]
        assert len(set(made.own.values())) == len(made.own) == shared > 10
        assert not set(made.own.values()) & set(range(8))
    assert audit_rows(audit_filters(docs, known, most_ambiguous=most)) == brute_audit(rows, labels)


def test_csr_shards_hold_the_counts(documents):  # noqa: F811
    docs = documents((1, "a b a"), (2, None), (3, "b"))
    made = coder(dictionary(docs.select("text")))
    cells = {}
    for r in csr_shards(docs.select("doc_id", "text").coalesce(1), made).collect():
        indptr, codes, counts = (np.frombuffer(r[c], t) for c, t in (("indptr", np.int64), ("codes", np.uint64), ("counts", np.int64)))
        for i, doc in enumerate(r["doc_ids"]):
            cells[doc] = sorted(counts[indptr[i] : indptr[i + 1]].tolist())
            assert len(set(codes[indptr[i] : indptr[i + 1]].tolist())) == len(cells[doc])
    assert cells == {1: [1, 2], 2: [], 3: [1]}


def test_audit_edges(spark, edges, nothing):  # noqa: F811
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    found = audit_filters(edges, labels)
    assert found.count() == 600
    first = found.where("filter_order = 'ABCDE' AND step = 1").first()
    assert first["kept"] + first["removed"] == edges.count() and first["good_lost"] == first["toxic_lost"] == 1
    assert audit_filters(nothing, labels).count() == 0
    assert audit_filters(edges, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


# --- prefix trie -------------------------------------------------------------------------


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    nodes = {}
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        ends = sorted(c for c in convs if built[c] == prefix)
        nodes[prefix] = (
            min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs),
            sum(len(p) == len(prefix) + 1 for p in below),
            sum(not any(len(q) > len(p) and q[: len(p)] == p for q in below) for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return Counter(nodes.values())


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_rows(frame):
    return Counter(tuple(r[c] for c in NODE) for r in frame.collect())


@pytest.fixture(scope="module")
def talks(spark):
    draw = random.Random(7)
    rows = []
    for c in [*range(-6, 45), 10**15]:
        for t in range(draw.choice([1, 2, 5, 12, 20])):
            if c % 7:
                rows.append((c, draw.choice([t, t, None]), draw.choice(["user", None]), draw.choice(["a", "bé", "", None])))
    rows += [(c, t, "user", "same") for c in (100, 101, 102, 103, 104, 200, 300) for t in range(12)]
    rows += [(None, 0, "user", "x"), (3, 1, "user", "again"), (3, 1, "user", "again")]
    draw.shuffle(rows)
    schema = "conv_id bigint, turn bigint, role string, text string, part int, depth string, p1 bigint"
    return rows, spark.createDataFrame([(*r, 1, "x", 5) for r in rows], schema)


@pytest.mark.parametrize("counters", [trie.MOST_COUNTERS, 1, 64])
def test_trie_against_brute_force(talks, counters):
    """Whatever the sketch says: one counter, 64, or enough of them."""
    rows, frame = talks
    assert trie_rows(prefix_trie(frame, most_counters=counters)) == brute_trie(rows)


def test_trie_of_a_conversation_in_many_parts(spark, talks, monkeypatch):
    """Turns of one conversation lie in many partitions, and a node's ends in several strings."""
    monkeypatch.setattr(trie, "CHUNK_IDS", 2)
    rows = [(c, t, "user", f"{t}") for c in (5, 6, 7, 8) for t in range(60)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(9)
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = trie._turns(frame, "conv_id", "turn", "role", "text")
        assert turns.groupBy("conv").agg(F.count_distinct("part").alias("n")).agg(F.max("n")).first()[0] > 3
        assert trie_rows(prefix_trie(frame)) == brute_trie(rows)
    finally:
        spark.conf.set(setting, before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sketch_never_underestimates(spark):
    draw = np.random.default_rng(1)
    digests = draw.integers(-(2**63), 2**63 - 1, 3000)
    digests[:500] = digests[500:1000]
    frame = spark.createDataFrame([(int(d), int(d) * 7 % 2**63) for d in digests.tolist()], "p1 bigint, p2 bigint")
    second = np.array([int(d) * 7 % 2**63 for d in digests.tolist()], np.int64)
    counts = Counter(digests.tolist())
    for counters in (1, 1 << 10, 1 << 20):
        rows = trie.sketch(frame, counters)
        found = trie._reached_two(rows[0], digests, counters) & trie._reached_two(rows[1], second, counters)
        assert all(found[[counts[d] > 1 for d in digests.tolist()]])
    assert found.mean() < 0.4


def test_trie_edges(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    assert prefix_trie(spark.createDataFrame([], schema)).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).count() == 0
    rows = [(1, 0, None, None)]
    assert trie_rows(prefix_trie(spark.createDataFrame(rows, schema))) == brute_trie(rows)
    long = [(0, t, "user", "x" * (200_000 if t == 9 else 3)) for t in range(12)]
    assert trie_rows(prefix_trie(spark.createDataFrame(long, schema))) == brute_trie(long)


# --- toxicity ----------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        own = [i]
        for j, y in enumerate(b, 1):
            own.append(min(row[j] + 1, own[-1] + 1, row[j - 1] + (x != y)))
        row = own
    return row[-1]


@pytest.mark.parametrize("states", [toxicity.MOST_STATES, 1])
def test_automaton_against_plain_distances(states):
    draw = random.Random(3)
    terms = [Term("".join(draw.choice("abcdé") for _ in range(draw.randint(2, 10))), False) for _ in range(40)]
    terms += [Term("abca", True), Term("dd", True)]
    words = ["".join(draw.choice("abcdéx😀") for _ in range(draw.randint(1, 12))) for _ in range(2500)] + [t.text for t in terms]
    sizes = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    automaton = Automaton(terms, states)
    for _ in range(2):
        found = automaton.match(points, np.cumsum(sizes) - sizes, sizes).tolist()
        for word, hit in zip(words, found, strict=True):
            near = [(distance(word, t.text), i) for i, t in enumerate(terms) if not t.stem and distance(word, t.text) <= edits_of(t.text)]
            near += [(0, i) for i, t in enumerate(terms) if t.stem and word.startswith(t.text)]
            assert (hit < 0) is (not near)
            if near:
                assert hit & 3 == min(near)[0] and (hit & 3, hit >> 2) in near


def test_tokens_and_context():
    t = tokens(['He said "idiot". You 1d1ot, id-iot!', "", None or " ", "that $cum c@t"])
    found = ["".join(map(chr, t.points[s : s + n])) for s, n in zip(t.starts, t.sizes, strict=True)]
    assert found == ["he", "said", "idiot", "you", "1d1ot", "id-iot", "that", "cum", "c@t"]
    assert t.bounds.tolist() == [0, 6, 6, 6, 9]
    assert context_factor(t, 2, 0, 6) == toxicity.QUOTED * toxicity.REPORTED
    alone = tokens(["you idiot", "the idiot"])
    assert context_factor(alone, 1, 0, 2) == toxicity.ADDRESSED
    assert context_factor(alone, 3, 2, 4) == 1.0


@pytest.fixture(scope="module")
def insults(spark, documents):  # noqa: F811
    draw = random.Random(5)
    plain = ["river", "stone", "window", "garden", "letter", "morning", "quiet", "paper", "bridge", "summer", "yellow", "market"]
    bad = ["blockhead", "nitwit", "dunderhead"]

    def text(kind):
        words = [draw.choice(plain) + draw.choice(["", "s", "ly"]) for _ in range(draw.randint(8, 60))]
        for _ in range(draw.randint(1, 4) if kind else 0):
            words.insert(draw.randint(0, len(words)), draw.choice(bad))
        return " ".join(words)

    rows = [(i, text(i % 3 == 0)) for i in range(600)]
    copied = "peculiar chandelier beside the harbour"
    rows += [(i, copied) for i in range(600, 660)]  # copies of one toxic text: one context
    labels = [(i, 1 if i % 3 == 0 or i >= 600 else 0) for i, _ in rows]
    return rows, labels


def test_misspelled_and_quoted_terms(spark, documents, insults):  # noqa: F811
    rows, labels = insults
    cases = {
        1000: "the river stone window was a blockhaed by the garden morning", 1001: "market nitwitt paper bridge summer yellow",
        1002: "market river paper bridge summer yellow", 1003: 'they wrote the word "blockhead" in the letter on paper by the window',
        1004: "peculiar chandelier", 1005: None, 1006: "",
    }
    docs = documents(*rows, *cases.items())
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = by(score_toxicity(docs, known, F.col("doc_id") >= 1000), "doc_id")
    assert [found[i]["predicted"] for i in (1000, 1001, 1002)] == [1, 1, 0]
    assert found[1003]["score"] < found[1000]["score"]
    assert found[1004]["predicted"] == found[1005]["predicted"] == found[1006]["predicted"] == 0
    right = np.mean([found[i]["predicted"] == y for i, y in labels if i < 600])
    assert right > 0.99 and all(found[i]["held_out"] is (i >= 1000) for i in found)


def test_toxicity_on_held_out_labels(spark):
    found = by(op13_toxicity(spark, TABLES), "doc_id")
    labels = {r["doc_id"]: r["toxic"] for r in read_table(spark, TABLES, "labels").collect()}
    held = [(found[i]["predicted"], y) for i, y in labels.items() if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(found) == 1000 and all(found[i]["held_out"] is (zlib.crc32(str(i).encode()) % 3 == 1) for i in found)
    # A few labels of this table mark texts without any such word.
    assert np.mean([p == 1 for p, y in held if y == 1]) > 0.8 and np.mean([p == 0 for p, y in held if y == 0]) > 0.98


def test_toxicity_edges(spark, edges, nothing, documents):  # noqa: F811
    never = F.lit(False)
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    found = score_toxicity(edges, empty, never)
    assert found.count() == edges.count() and found.where("score != 0 OR predicted != 0").count() == 0
    one = spark.createDataFrame([(4, 1), (4, 0), (5, 1), (None, 0), (6, None)], "doc_id bigint, toxic int")
    assert {r["score"] for r in score_toxicity(edges, one, never).collect()} == {1.0}
    mixed = spark.createDataFrame([(4, 1), (8, 0)], "doc_id bigint, toxic int")
    assert score_toxicity(edges, mixed, never).where("score BETWEEN 0 AND 1").count() == edges.count()
    assert score_toxicity(nothing, mixed, never).count() == 0
    assert toxicity.text_features(Automaton([]), np.zeros((0, 3)), pa.array(["x", None, ""])).tolist() == [[0.0] * 3] * 3
