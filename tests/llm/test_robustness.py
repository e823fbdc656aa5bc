"""Long and hostile texts, null and repeated ids, large numbers: against brute force."""

import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from conftest import by
from llm_fixtures import documents, edges, nothing  # noqa: F401
from pyspark.sql import functions as F
from test_dedup import brute_near

import corpus_pipeline
from payerlens.llm import dom, line_dedup
from payerlens.llm.dom import Shapes, pack as packed_tree, parse, unpack
from payerlens.llm.html_extract import extract_main_text, main_text
from payerlens.llm.line_dedup import dedup_lines
from payerlens.llm.near_dedup import near_duplicates
from payerlens.llm.packing import pack
from payerlens.llm.secret_scan import candidates, scan_secrets
from payerlens.llm.topk_search import Bucket, exact_products, top_products

# --- secret scan -------------------------------------------------------------------------

KEYS = "pass pwd secret token key auth cred bearer jwt session cookie signature salt pin license licence webhook kennwort contrase clave senha".split()


def assignments(word):
    """(place after the sign, place of the name) of every assignment to a key-like name, read letter by letter."""
    name = lambda c: c.isalpha() or c.isdigit() or c in "_-.[]()"
    out, i = [], 0
    while i < len(word):
        if not name(word[i]):
            i += 1
            continue
        j = i
        while j < len(word) and name(word[j]):
            j += 1
        k = j
        while k < len(word) and word[k] in "\"'`":
            k += 1
        sign = next((s for s in (":=", "=>", "===", "==", "=", ":") if word.startswith(s, k)), "")
        if sign and any(p in word[i:j].lower() for p in KEYS):
            out.append((k + len(sign), i))
        i = j
    return out


def brute_values(word):
    out = []
    for at, _ in assignments(word):
        if at < len(word) and word[at] in "\"'`":
            value = re.split("[\"'`]", word[at + 1 :])[0]
            out.append(value)
    for part in re.split(r"[&;,](?=[A-Za-z0-9_.\-\[\]\"']*[=:])", word):
        open_ = [at for at, _ in assignments(part) if at < len(part) and part[at] not in "\"'`"]
        if open_:
            out.append(part[open_[0] :].rstrip(",;"))
    return {v for v in out if v}


def test_values_of_names_against_a_plain_reading(spark, documents):  # noqa: F811
    draw = random.Random(4)
    bits = ["password", "api_key", "x", "a😀", "中文", "=", ":", ":=", "==", "=>", '"', "'", "`", "&", ";", ",", "Token", "v1", ".", "-", "b"]
    words = ["".join(draw.choice(bits) for _ in range(draw.randint(1, 9))) for _ in range(1500)]
    found = candidates(documents(*enumerate(words)), "doc_id", "text", "source").where("keyed").collect()
    got = {}
    for r in found:
        got.setdefault(r["doc_id"], set()).add(r["finding"])
    for i, word in enumerate(words):
        trimmed = lambda v: v.lstrip("\"'`([{<").rstrip("\"'`)]}>.,;:")
        runs = [r for r in re.findall(r"[A-Za-z0-9_+/=\-]{16,}", word) if re.search("[0-9]", r)]
        expected = {v for v in brute_values(word) if trimmed(v) not in runs}
        assert {v for v in got.get(i, set()) if v not in runs} == expected, word


@pytest.mark.parametrize("text", [
    "token:" + "中文a😀" * 250_000, 'password="' + "a😀" * 400_000, "pass" * 250_000, "pass" * 250_000 + "=x", "password=" + "a;b=" * 250_000,
    "key=" + "," * 1_000_000, "key " * 250_000, "key: " * 200_000, "é" * 1_000_000 + "=", "key" + " " * 1_000_000 + "x", "=" * 1_000_000,
    "a1" * 500_000, "key='" * 200_000,
])
def test_long_words_end_in_seconds(spark, documents, text):  # noqa: F811
    docs = documents((1, text), (2, 'api_key = "0123456789abcdef0123"'))
    start = time.perf_counter()
    found = [r["finding"] for r in candidates(docs, "doc_id", "text", "source").where("doc_id = 2").collect()]
    candidates(docs, "doc_id", "text", "source").agg(F.sum(F.length("finding"))).collect()
    assert found == ["0123456789abcdef0123"] and time.perf_counter() - start < 60


def test_long_value_is_found_whole(spark, documents):  # noqa: F811
    value = "a😀中" * 50_000
    found = {r["finding"] for r in scan_secrets(documents((1, f"password='{value}' end"), (2, f"token:{value}"))).collect()}
    assert found == {value}


# --- line dedup --------------------------------------------------------------------------


def brute_ranges(rows, codes):
    """(id, text) -> numbers of the lines that go: of every window all occurrences but the first."""
    order = lambda i, t: (i is not None, i or 0, codes[t])
    places = {}
    for i, t in set(rows):
        lines = t.split("\n") if t is not None else []
        for p in range(len(lines) - 2):
            places.setdefault(tuple(lines[p : p + 3]), set()).add((order(i, t), p, i, t))
    gone = {}
    for at in places.values():
        for _, p, i, t in sorted(at, key=lambda x: x[:2])[1:]:
            gone.setdefault((i, t), set()).update((p, p + 1, p + 2))
    return gone


@pytest.mark.parametrize("bits", [64, 31, 1])
def test_lines_without_ids(spark, documents, monkeypatch, bits):  # noqa: F811
    """One code of a text may be shared: the second one tells texts apart. Null ids go by their text."""
    real = line_dedup._codes
    if bits < 64:
        monkeypatch.setattr(line_dedup, "_codes", lambda text: [F.pmod(real(text)[0], F.lit(2**bits)), real(text)[1]])
    draw = random.Random(bits)
    lines = [f"line {n}" for n in range(12)]
    texts = ["\n".join(draw.choice(lines) for _ in range(draw.randint(1, 9))) for _ in range(60)]
    unique = ["\n".join(f"only {t} {n}" for n in range(5)) for t in range(40)]
    rows = [(draw.choice([None, None, 5, 6, 7]), t) for t in texts] + [(None, t) for t in unique] + [(None, None), (None, "")]
    docs = documents(*rows, *rows[:20])
    codes = {r["text"]: (r["x"], r["y"]) for r in docs.select("text", *[c.alias(n) for c, n in zip(line_dedup._codes(F.col("text")), "xy", strict=True)]).collect()}
    assert len(set(codes.values())) == len(codes) and (bits > 1 or len({x for x, _ in codes.values()}) == 2)
    gone = brute_ranges(rows, codes)
    expected = Counter()
    for i, t in [*rows, *rows[:20]]:
        lost = gone.get((i, t), set())
        expected[i, t if not lost else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in lost), len(lost)] += 1
    assert Counter((r["doc_id"], r["text"], r["removed_lines"]) for r in dedup_lines(docs).collect()) == expected
    assert len(gone) > 3 and not any((None, t) in gone for t in unique)


# --- exact top-k -------------------------------------------------------------------------


def brute_top(rows, k):
    whole = lambda v: [int(np.floor(256 * x)) if abs(256 * x) < 2**53 else int(256 * x) for x in v]
    vectors = {(i, tuple(whole(v))) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for i, v in vectors:
        if i % 50 == 0:
            scores = sorted(
                (-max(min(sum(a * b for a, b in zip(v, w, strict=True)), 2**63 - 1), -(2**63)), j)
                for j, w in vectors if j != i and len(v) == len(w))
            out |= {(i, n, j, -s) for n, (s, j) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("size", [1.0, 300.0, 1e5, 1e12, 1e200])
def test_components_of_any_size(spark, size):
    draw = np.random.default_rng(int(size) % 97)
    rows = [(i, (draw.normal(0, 1, 6) * size * draw.choice([0.01, 1.0])).tolist()) for i in range(260)]
    rows += [(300, [size] * 6), (301, [size] * 6), (302, [0.0] * 6), (350, [0.0] * 6), (303, [float("nan")] * 6), (304, [float("inf")] + [0.0] * 5), (305, None), (306, [None] * 6)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = top_products(frame, F.col("vec_id") % 50 == 0, bucket_rows=64, query_rows=5).collect()
    assert {tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in found} == brute_top(rows, 5)


def test_products_are_exact():
    for size in (10, 10**7, 10**9, 10**15):
        draw = random.Random(size)
        a, b = ([[float(draw.randint(-size, size)) for _ in range(7)] for _ in range(9)] for _ in range(2))
        exact = [[max(min(sum(int(x) * int(y) for x, y in zip(p, q, strict=True)), 2**63 - 1), -(2**63)) for q in b] for p in a]
        assert exact_products(np.array(a), np.array(b)).tolist() == exact


def test_pruning_keeps_what_reaches_the_bound():
    draw = np.random.default_rng(3)
    vectors = np.floor(draw.normal(0, 60, (300, 8)))
    bucket = Bucket(np.arange(300), vectors)
    queries = np.floor(draw.normal(0, 60, (40, 8)))
    scores = queries @ bucket.vectors.T
    for place in (1, 5, 50):
        bounds = np.sort(scores, 1)[:, -place]
        possible = bucket.possible(queries, bounds)
        assert possible[scores >= bounds[:, None]].all()
        if place == 1:
            assert possible.mean() < 0.9


# --- packing -----------------------------------------------------------------------------


def test_pieces_without_ids_spread(spark, documents):  # noqa: F811
    rows = [(None, f"w{i % 300} " * (1 + i % 5)) for i in range(900)] + [(7, "same text here")] * 400 + [(None, None), (None, "")]
    found = pack(documents(*rows), max_length=4, token_budget=16)
    got = found.collect()
    expected = Counter()
    for _, t in rows:
        n = len((t or "").split())
        for p in range(max(1, -(-n // 4))):
            expected[min(4, n - 4 * p)] += 1
    assert Counter(r["length"] for r in got) == expected
    places = [(r["bucket"], r["batch"], r["slot"]) for r in got if r["bucket"] is not None]
    assert len(set(places)) == len(places)
    for bucket in {b for b, _, _ in places}:
        size = max(16 // next(r["padded_length"] for r in got if r["bucket"] == bucket), 1)
        numbers = sorted(size * b + s for x, b, s in places if x == bucket)
        assert numbers == list(range(len(numbers)))


def test_no_task_gets_all_rows_without_id(spark, documents):  # noqa: F811
    """Rows without id have orders of their own: no shard of 4,096 holds more than a few different texts."""
    from payerlens.llm import packing

    rows = packing._documents(documents(*[(None, f"text {i}") for i in range(3000)], *[(None, "copy")] * 1000), "doc_id", "text", F.lit(2))
    assert rows.count() == 3001 and rows.agg(F.max("copies")).first()[0] == 1000
    shards = rows.withColumn("piece", F.lit(0)).groupBy(F.substring(packing._order_key(1), 1, 2)).count()
    assert shards.agg(F.max("count")).first()[0] < 60


def test_many_copies_are_numbered_in_chunks(spark, documents, monkeypatch):  # noqa: F811
    from payerlens.llm import packing

    rows = [(1, "a b c")] * 57 + [(2, "d e")] * 3
    whole = Counter(tuple(r) for r in pack(documents(*rows), max_length=2).collect())
    monkeypatch.setattr(packing, "COPY_CHUNK", 10)
    assert Counter(tuple(r) for r in pack(documents(*rows), max_length=2).collect()) == whole


# --- HTML --------------------------------------------------------------------------------


@pytest.mark.parametrize("page, text", [
    ("<p title=it's>First text</p><p>don't go</p><p>Third</p>", "First text\ndon't go\nThird"),
    ('<p class="x"">Hello</p>', "Hello"), ("<p a=\"x>y\" b='z>'>T</p>", "T"), ("<a href=x/y>L</a>", "L"),
    ('<p title="never closed>A</p><p>B</p>', "A\nB"), ('text <p class="x', "text"), ("<p a==\"b\">A</p>", "A"),
    ("<p a = \"b>c\" >A</p>", "A"), ("a < b and c > d", "a < b and c > d"), ("<p 'x' \"y\">A</p>", "A"),
])
def test_quotes_in_tags(page, text):
    root = parse(page)
    assert main_text(root, set()) == text
    assert main_text(unpack(packed_tree(root)), set()) == text


def test_names_are_read_beside_stray_quotes():
    assert parse("<div class='a'' id=b\">x</div>").children[0].names.split()[0] == "a"


def test_packed_trees_are_equal():
    draw = random.Random(2)
    page = "".join(draw.choice(["<div class='c d'>", "</div>", "<p>", "t é 😀", "<br>", "</p>", "<ul><li>x</ul>"]) for _ in range(400))

    def flat(node):
        return [(n.tag, n.names, n.text, len(n.children)) for n in _walk(node)]

    assert flat(parse(page)) == flat(unpack(packed_tree(parse(page))))
    deep = "<div>" * 20_000 + "x"
    assert len(flat(unpack(packed_tree(parse(deep))))) == 20_002


def _walk(node):
    todo = [node]
    while todo:
        node = todo.pop()
        yield node
        todo.extend(reversed(node.children))


def plain_matching(a, b):
    if (a.tag, a.names) != (b.tag, b.names):
        return 0
    table = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children, 1):
        for j, y in enumerate(b.children, 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + plain_matching(x, y))
    return 1 + table[-1][-1]


def random_tree(draw, depth):
    inner = "".join(random_tree(draw, depth - 1) for _ in range(draw.randint(0, 4))) if depth else ""
    tag = draw.choice(["div", "span", "b"])
    return f"<{tag}>{inner}</{tag}>"


def test_alignment_against_plain_dynamic_programming():
    draw = random.Random(8)
    for _ in range(150):
        a, b = parse(random_tree(draw, 3)), parse(random_tree(draw, 3))
        shapes = Shapes()
        shapes.assign(a)
        shapes.assign(b)
        assert shapes._weight(a, b) == plain_matching(a, b)


@pytest.mark.parametrize("cells, gap", [(4, 1 << 22), (4, 64)])
def test_cut_alignments_keep_the_order(monkeypatch, cells, gap):
    """Anchors, linear space and halves on small trees: order-preserving, and little worse than the optimum."""
    monkeypatch.setattr(dom, "TABLE_CELLS", cells)
    monkeypatch.setattr(dom, "GAP_CELLS", gap)
    draw, lost, whole = random.Random(6), 0, 0
    for _ in range(80):
        a, b = (parse("".join(random_tree(draw, 1) for _ in range(draw.randint(8, 20)))) for _ in range(2))
        shapes = Shapes()
        shapes.assign(a)
        shapes.assign(b)
        pairs = shapes._align(a.children, b.children)[1]
        weight = sum(plain_matching(a.children[x], b.children[y]) for x, y in pairs)
        assert all(x < u and y < v for (x, y), (u, v) in zip(pairs, pairs[1:], strict=False))
        best = plain_matching(a, b) - 1
        assert weight <= best
        lost, whole = lost + best - weight, whole + best
    assert lost <= (0.2 if gap > 64 else 0.4) * whole


def test_thousands_of_differing_blocks_align_in_seconds():
    draw = random.Random(1)

    def page(n):
        marks = ["<b>x</b>", "<i>y</i>", "t", "<a>z</a>"]
        return "".join("<p>" + "".join(draw.choice(marks) for _ in range(draw.randint(3, 12))) + "</p>" for _ in range(n))

    shapes, a, b = Shapes(), parse(page(5000)), parse(page(5000))
    shapes.assign(a)
    shapes.assign(b)
    start = time.perf_counter()
    assert len(shapes.match(a, b)) > 4000 and time.perf_counter() - start < 30


def test_pages_are_parsed_once(spark, monkeypatch, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    from payerlens.llm import html_extract

    real = html_extract._parsed_rows

    def counting(batches):
        for out in real(batches):
            calls.add(len(out))
            yield out

    monkeypatch.setattr(html_extract, "_parsed_rows", counting)
    rows = [(i, f"http://h{i % 2}.example/{i}", f"<body><p>Menu of all</p><article><p>text {i} of the page</p></article></body>") for i in range(40)]
    found = by(extract_main_text(spark.createDataFrame([*rows, (None, None, None)], "page_id int, url string, html string")), "page_id")
    assert calls.value == 41 and found[3]["text"] == "text 3 of the page" and found[None]["text"] == ""


# --- pipeline ----------------------------------------------------------------------------


def test_table_loaded_twice_leaves_one_row_a_group(spark, documents, edges, nothing):  # noqa: F811
    draw = random.Random(3)
    long = [" ".join(draw.choice("abcdefghij") + str(draw.randint(0, 30)) for _ in range(60)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(long)] + [(100 + i, t + " more") for i, t in enumerate(long[:4])]
    rows += [(None, long[0]), (None, "a text that nobody else has, of more than five words"), (5, "another text under an id that is there already")]
    rows += [(200, ""), (201, ""), (None, None), (None, "")]
    once = corpus_pipeline.near_dedup(spark, documents(*rows), "").select("doc_id", "text").collect()
    twice = corpus_pipeline.near_dedup(spark, documents(*rows, *rows), "").select("doc_id", "text").collect()
    assert Counter(map(tuple, once)) == Counter(map(tuple, twice))
    ids = Counter(r["doc_id"] for r in once)
    assert ids[0] == 1 and ids[5] == 2 and not any(i in ids for i in range(100, 104)) and ids[200] == ids[201] == 1
    assert ids[None] == 2 and {r["text"] for r in once if r["doc_id"] is None} <= {None, "", rows[17][1]}
    near = {i for i, _, _, stays in brute_near(rows[:16], 5, 80) if stays}
    assert {r["doc_id"] for r in once if r["text"] in {t for _, t in rows[:16]}} == near
    assert corpus_pipeline.near_dedup(spark, nothing, "").count() == 0
    assert corpus_pipeline.near_dedup(spark, edges, "").count() == len(set(edges.select("doc_id", "text").collect())) - 1


def test_empty_table_passes_all_stages(spark, nothing):  # noqa: F811
    docs = nothing
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0, name


def test_near_duplicates_by_row_number(spark, documents):  # noqa: F811
    docs = documents((1, "one two three four five six"), (1, "one two three four five six"))
    assert near_duplicates(docs.withColumn("node", F.monotonically_increasing_id()), id_column="node").where("kept").count() == 1
