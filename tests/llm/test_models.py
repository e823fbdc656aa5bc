import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import by
from llm_fixtures import documents, edges, nothing  # noqa: F401
from pyspark.sql import functions as F

from payerlens.llm.dom import Shapes, parse
from payerlens.llm.html_extract import extract_main_text, main_text
from payerlens.llm import language_id
from payerlens.llm.language_id import identify_languages, train
from payerlens.llm.quality import LABELLERS, classify_quality, fit_accuracies, vote_patterns
from payerlens.llm.secret_scan import dictionary, scan_secrets
from payerlens.llm.tables import read_table

TABLES = "/root/testdata/sf0.01"


def test_em_finds_the_accuracies():
    """Votes drawn from known accuracies: posteriors follow the exact Bayes rule."""
    draw = np.random.default_rng(1)
    truth = draw.random(40_000) < 0.7
    right = [0.95, 0.9, 0.85, 0.7, 0.8, 0.9, 0.6][: len(LABELLERS)]
    votes = [np.where(draw.random(len(truth)) < r, truth, ~truth).astype(int) for r in right]
    code = np.zeros(len(truth), np.int64)
    for v in votes:
        code = 3 * code + v
    patterns, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    posterior = fit_accuracies(patterns, counts.astype(float))
    log = np.log(0.7 / 0.3) + sum(
        np.where(v == 1, 1, -1) * np.log(r / (1 - r)) for v, r in zip(votes, right, strict=True)
    )
    assert np.abs(posterior[inverse] - 1 / (1 + np.exp(-log))).mean() < 0.02


def test_quality_against_held_labels(spark):
    scored = by(classify_quality(read_table(spark, TABLES, "documents")), "doc_id")
    labels = {r["doc_id"]: r["quality"] for r in read_table(spark, TABLES, "labels").collect()}
    kept = {q: np.mean([scored[i]["kept"] for i, v in labels.items() if v == q]) for q in (0, 1)}
    assert len(scored) == 1000 and kept[1] > 0.99 and kept[0] < 0.1


def test_quality_edges(edges, nothing):
    found = classify_quality(edges, keep=["doc_id", "words", "n"])
    assert found.columns == ["doc_id", "words", "n", "weak_posterior", "quality_score", "kept"]
    assert found.count() == edges.count()
    assert classify_quality(nothing).count() == 0
    assert vote_patterns(np.zeros((0, len(LABELLERS)))).shape == (0,)


def test_language_held_out_accuracy(spark):
    docs = read_table(spark, TABLES, "documents")
    rows = identify_languages(docs, F.crc32(F.col("doc_id").cast("string")) % 4 == 2).collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(rows) == 1000 and len(held) > 200 and np.mean(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark, edges, nothing, documents):
    never = F.lit(False)
    found = identify_languages(edges, never)
    assert found.count() == edges.count()
    unknown = {r["doc_id"] for r in found.where("lang_pred = 'und'").collect()}
    assert unknown == {1, 2, 3, 11, None}
    assert found.where("lang_pred = 'und' AND (score != 0 OR accepted)").count() == 0
    assert identify_languages(nothing, never).count() == 0
    unlabelled = documents((1, "text", None, "s"), (2, None, None, "s"))
    assert [tuple(r)[1:] for r in identify_languages(unlabelled, never).collect()] == [(False, "und", 0.0, False)] * 2


def test_language_column_with_very_many_values(spark, monkeypatch):
    """100,000 values: what reaches the driver is bounded, frequent languages are learned all the same."""
    learned = []

    def counting(rows, labels, **options):
        learned.append(labels)
        return train(rows, labels, **options)

    monkeypatch.setattr(language_id, "train", counting)
    many = spark.range(100_000).selectExpr(
        "id AS doc_id", "concat('abc def ', id % 7, ' text') AS text", "concat('dirt', id) AS lang")
    real = spark.range(200_000, 200_400).selectExpr(
        "id AS doc_id", "IF(id % 2 = 0, 'the quick brown fox and the dog', 'der schnelle braune fuchs und der hund') AS text",
        "IF(id % 2 = 0, 'en', 'de') AS lang").withColumn("text", F.concat("text", F.lit(" "), F.col("doc_id").cast("string")))
    found = identify_languages(many.unionByName(real), F.lit(False), sample_rows=60)
    assert found.count() == 100_400
    assert len(learned[0]) <= 120 and {"en", "de"} <= set(learned[0]) and len(set(learned[0])) == 60


def test_simple_tree_matching():
    shapes, draw = Shapes(), random.Random(4)

    def tree(depth):
        inner = "".join(tree(depth - 1) for _ in range(draw.randint(0, 3))) if depth else ""
        tag = draw.choice(["div", "span", "b"])
        return f"<{tag}>{inner}</{tag}>"

    def matching(a, b):
        if (a.tag, a.names) != (b.tag, b.names):
            return 0
        rows = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
        for i, x in enumerate(a.children):
            for j, y in enumerate(b.children):
                rows[i + 1][j + 1] = max(rows[i][j + 1], rows[i + 1][j], rows[i][j] + matching(x, y))
        return rows[-1][-1] + 1

    for _ in range(60):
        one, two = parse(tree(3)), parse(tree(3))
        shapes.assign(one)
        shapes.assign(two)
        assert shapes._weight(one, two) == matching(one, two)


def test_main_text_of_layouts():
    page = (
        "<html><head><title>t</title></head><body><header>Top</header><nav><a>x</a></nav>"
        "<div class='cookie-notice'>We use</div><main><h2>A&nbsp;b &amp; c</h2><p>One <b>two</b>\n three"
        "<p>four<ul><li>x<li>y</ul><section class='comments'><p>hi</p></section><form>f</form></main>"
        "<aside>s</aside><!-- c --><script>var t='</p>';</script><footer>z</footer>"
    )
    assert main_text(parse(page), set()) == "A b & c\nOne two three\nfour\nx\ny"
    assert main_text(parse(""), set()) == ""
    assert main_text(parse("<p>a<br>b"), set()) == "a\nb"
    assert main_text(parse("plain &lt; text"), set()) == "plain < text"
    deep = "<div>" * 5000 + "end" + "</div>" * 5000
    shapes, root = Shapes(), parse(deep)
    shapes.assign(root)
    assert main_text(root, set()) == "end" and len(shapes.match(root, root)) == 1


def test_wrapper_induction_drops_constant_slots(spark):
    """Pages without landmarks: what all pages of a host repeat goes, what varies stays."""
    body = "<html><body><div><p>Read our magazine daily</p><p>Story {0} begins</p><p>and ends {0}</p></div></body></html>"
    rows = [(n, f"http://a.example/{n}", body.format(n)) for n in range(30)]
    rows += [(100, "http://b.example/1", body.format(7)), (101, None, None), (102, "x", ""), (103, None, body.format(1))]
    rows += [(0, "http://a.example/0", body.format(0))]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id int, url string, html string, host string, slot int")
    found = extract_main_text(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    texts = Counter((r["page_id"], r["text"]) for r in found.collect())
    assert texts == Counter(
        [(n, f"Story {n} begins\nand ends {n}") for n in range(30)]
        + [(0, "Story 0 begins\nand ends 0"), (101, ""), (102, "")]
        + [(100, "Read our magazine daily\nStory 7 begins\nand ends 7"), (103, "Read our magazine daily\nStory 1 begins\nand ends 1")]
    )
    assert found.where("n_chars != length(text)").count() == 0
    assert extract_main_text(pages.where("page_id < 0")).count() == 0


def test_secret_scan(spark, documents, edges, nothing):
    docs = read_table(spark, TABLES, "documents")
    found = scan_secrets(docs).collect()
    secret = [r for r in found if len(r["finding"]) == 40]
    assert secret and all(r["reported"] for r in secret)
    assert not any(r["reported"] for r in found if r["finding"].isdigit())
    alone = scan_secrets(documents((1, 'token = "0123456789abcdef0123"'), (2, None))).collect()
    assert [(r["doc_id"], r["word_position"], r["score"], r["reported"]) for r in alone] == [(1, 2, None, True)]
    assert scan_secrets(nothing).count() == 0
    assert scan_secrets(edges).count() == 0
    given = spark.createDataFrame([("1111111111111111", 0.0), ("a1b2c3d4e5f6a7b8", 1.0)], "finding string, label double")
    two = scan_secrets(documents((1, "n 1111111111111111 x"), (2, "key a1b2c3d4e5f6a7b8 y")), findings=given)
    assert {r["finding"] for r in two.collect()} == {"1111111111111111", "a1b2c3d4e5f6a7b8"}
    assert pa.__version__


def test_secret_dictionary_and_labels_cover_all_documents(spark, documents):
    """A rare label and the words of long documents count, however few rows the sample has."""
    long = "lorem " * 10_000 + "Zyzzyva-Quokkafarm-77"
    rows = [(i, f"see item number 77{i:018d} of many") for i in range(300)]
    rows += [(1000 + i, f'x apikey = "a{i}b2c3d4e5f6a7b8c9d0e1" y') for i in range(2)]
    rows += [(2000 + i, long + " quokkafarm") for i in range(3)]
    found = scan_secrets(documents(*rows), sample_rows=5).collect()
    assert len(found) == 305 and all(r["score"] is not None for r in found)
    assert all(r["reported"] for r in found if r["doc_id"] in (1000, 1001))
    entries = {r["entry"] for r in dictionary(documents(*rows), "text").collect()}
    assert {"quokkafarm", "zyzzyva", "lorem"} <= entries


def test_secrets_by_name_have_any_length_and_characters(documents):
    texts = {
        'password = "hunter2"': ["hunter2"],
        "DB_PASSWORD=p@ss.w0rd$! next": ["p@ss.w0rd$!"],
        'conf {"apiKey":"abcDEFghiJKLmnoPQRstu","n":1}': ["abcDEFghiJKLmnoPQRstu"],
        "user=a&token=x.y&secret=z&b=1": ["x.y", "z"],
        "Passwort: geheim, und": ["geheim"],
        'token = "0123456789abcdef0123"': ["0123456789abcdef0123"],
        "no assignment of a key here: 17": [],
    }
    rows = list(enumerate(texts))
    found = scan_secrets(documents(*rows)).orderBy("doc_id", "word_position", "part").collect()
    assert [(r["doc_id"], r["finding"]) for r in found] == [(i, f) for i, t in rows for f in texts[t]]
    assert all(r["reported"] for r in found)


def pages_of(spark, *rows):
    return spark.createDataFrame([*rows], "page_id int, url string, html string")


def test_copied_articles_are_no_template(spark):
    """Copies differ in comments and scripts only; nothing of their article is template."""
    body = "<html><body><!-- ad {0} --><script>t({0})</script><div><p>Daily magazine</p>{1}</div></body></html>"
    long = "".join(f"<p>Copied paragraph {k}</p>" for k in range(9))
    rows = [(n, f"http://a.example/{n}", body.format(n, long)) for n in range(15)]
    rows += [(n, f"http://a.example/{n}", body.format(n, f"<p>Story {n}</p>")) for n in range(15, 40)]
    # Near copies: a word differs, so they vote as different pages.
    rows += [(n, f"http://a.example/{n}", body.format(n, f"{long}<p>Word {n}</p>")) for n in range(40, 52)]
    texts = {r["page_id"]: r["text"] for r in extract_main_text(pages_of(spark, *rows)).collect()}
    copied = "\n".join(f"Copied paragraph {k}" for k in range(9))
    assert {texts[n] for n in range(15)} == {copied}
    assert all(texts[n] == f"Story {n}" for n in range(15, 40))
    assert all(texts[n] == f"{copied}\nWord {n}" for n in range(40, 52))


def test_container_names_do_not_drop_the_article():
    teaser = "<div class='sidebar'><p>More</p></div>"
    for name in ("content has-sidebar", "with-sidebar", "has-header", "share-price"):
        inner = "<h1>Title</h1><p>Long enough text of the article itself</p>"
        for tag in ("article", "main", "div"):
            page = f"<body><div class='{name}'><{tag}>{inner}</{tag}></div>{teaser}</body>"
            assert main_text(parse(page), set()) == "Title\nLong enough text of the article itself", (name, tag)
    page = "<body><div><p>Post</p></div><div class='comments'><article>A much longer comment here</article></div></body>"
    assert main_text(parse(page), set()) == "Post"
    page = "<body><article>Post</article><div class='comment-list'><p>A much longer comment</p></div></body>"
    assert main_text(parse(page), set()) == "Post"


def test_references_by_shape(spark):
    """Empty pages are no reference, and each layout of a host has its own template."""
    one = "<html><body><div class='a'><p>Daily magazine</p><p>Story {0}</p></div></body></html>"
    two = "<html><body><section class='b'><div><h2>Weekly</h2><p>Tale {0}</p></div></section></body></html>"
    rows = [(n, f"http://a.example/{n}", one.format(n)) for n in range(20)]
    rows += [(n, f"http://a.example/{n}", two.format(n)) for n in range(20, 35)]
    rows += [(n, f"http://a.example/{n}", None if n % 2 else "") for n in range(35, 60)]
    texts = {r["page_id"]: r["text"] for r in extract_main_text(pages_of(spark, *rows)).collect()}
    assert len(texts) == 60
    assert all(texts[n] == (f"Story {n}" if n < 20 else f"Tale {n}" if n < 35 else "") for n in texts)


def test_long_documents_and_rare_languages_are_learned(documents):
    french = "le chat noir dort sur la grande table rouge "
    rows = [(i, f"the black cat number {'abcdefgh'[i % 8]} sleeps on the big red table", "en") for i in range(60)]
    rows += [(100 + i, french * 700, "fr") for i in range(3)]
    found = {r["doc_id"]: r["lang_pred"] for r in identify_languages(documents(*rows), F.lit(False), sample_rows=20).collect()}
    assert found == {i: lang for i, _, lang in rows}
    long = documents(*[r for r in rows if r[0] >= 100])
    assert {r["lang_pred"] for r in identify_languages(long, F.lit(False)).collect()} == {"fr"}


def test_quality_learns_from_long_documents(documents):
    draw = random.Random(2)
    vocabulary = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(3000)]
    good = [(i, " ".join(draw.choices(vocabulary, k=4000))) for i in range(30)]
    bad = [(100 + i, " ".join(f"{w.upper()}###$$$ {w.upper()}###$$$" for w in draw.choices(vocabulary[:20], k=2000))) for i in range(10)]
    scored = {r["doc_id"]: r for r in classify_quality(documents(*good, *bad)).collect()}
    assert all(r["kept"] == (i < 100) for i, r in scored.items())
    assert all(r["quality_score"] != 0.5 for r in scored.values())
