import pytest  # noqa: E402

# Names that the operators use inside; as extra columns they must not disturb them.
CLASHING = (
    "words bands key component code place tokens epoch bucket slice copies recipe piece shard "
    "length offset domain language id n host_code in_0 _line_id kept_place finding hub"
).split()


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text[, lang, source]) with clashing extra columns."""

    def build(*rows):
        full = [(r + ("en", "src1"))[: max(4, len(r))] for r in ((*r, *("en", "src1")[len(r) - 2 :]) for r in rows)]
        full = [(i, t, lang, source, len(t or ""), *CLASHING) for i, t, lang, source, *_ in full]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, "
        return spark.createDataFrame(full, schema + ", ".join(f"`{c}` string" for c in CLASHING))

    return build


EDGES = [
    (1, None), (2, ""), (3, "   \n\t "), (None, "only a text without an id"), (None, None),
    (4, "word"), (4, "word"), (5, "word"), (6, "x" * 300_000), (7, "long words here " * 20_000),
    (8, "a\nb\nc\na\nb\nc\nd"), (9, "a\nb\nc"), (10, "déjà vu ñandú ß"), (11, "12345 67890 !!!"),
]


@pytest.fixture(scope="session")
def edges(documents):
    return documents(*EDGES)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents((1, "x")).where("doc_id < 0")
