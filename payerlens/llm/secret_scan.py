"""Secret scan with a random forest that removes false positives, in Spark built-ins.

Candidates are long runs of key characters with a digit, and the values of whatever is named
like a key (``password: x``, ``"api_key" = "y"``), of any length and characters. A forest scores each one from its
length, its transitions between character kinds, how much of it a dictionary covers, the
path (the document's source), the neighbouring words and such a name before it. It is trained from labelled
findings. Where none are given, the candidates supply them: a candidate assigned as a quoted
string is a finding, an unquoted value of a key-like name is unlabelled and trains nothing,
any other candidate is a false positive. Quotes and sign are no
features, so the forest has to learn from the rest.

The dictionary (words of several documents) counts all texts, candidates are searched in all
texts, and all of them are labelled and scored. Only the forest's training rows are sampled:
about ``sample_rows`` of each label, so a rare one is there in full.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payerlens.llm.samples import bounded_sample
from payerlens.llm.tables import stored

LEAST_LENGTH = 16
SAMPLE_ROWS = 20_000
LEAST_DOCUMENTS = 3  # that a word of the dictionary is in
TREES, DEPTH, SEED = 20, 6, 11
THRESHOLD = 0.5
_RUN = r"[A-Za-z0-9_+/=\-]{%d,}" % LEAST_LENGTH
_BLANKS = r"[\x20\x09-\x0D]+"
_HASHED = 64
# --- fixed values: parts of names that hold secrets, and how a value is assigned ----------
_PARTS = (
    "(?:pass|pwd|secret|token|key|auth|cred|bearer|jwt|session|cookie|signature|salt|pin|licen[cs]e|"
    "webhook|kennwort|contrase|clave|senha)"
)
_SIGN = r"(?>:=|=>|={1,3}+|:)"
# ------------------------------------------------------------------------------------------
# No group is repeated and every repetition is possessive, so Java matches neither recurse nor
# backtrack. A name starts where no name character is before it, so each is read once.
_NAME_CLASS = r"\p{L}\p{N}_\-.\[\]()"
_NAME = (
    f"(?i)(?<![{_NAME_CLASS}])(?=[{_NAME_CLASS}]*?{_PARTS})[{_NAME_CLASS}]++[\"'`]*+"
)
_QUOTED = _NAME + _SIGN + "[\"'`]([^\"'`]++)"
_UNQUOTED = "(?s)" + _NAME + _SIGN + "([^\\s\"'`].*)$"
_FURTHER = "[&;,](?=[\\w.\\-\\[\\]\"']*+[=:])"  # a separator with a further assignment behind it

FEATURES = (
    "length", "digit_share", "letter_share", "capital_share", "hex_share", "kind_changes",
    "case_changes", "distinct_share", "dictionary_share", "path_code", "before_code",
    "before2_code", "after_code", "keyed_code",
)


def _ends_in_sign(word: Column) -> Column:
    return F.substring(word, -1, 1).isin("=", ":", ">")


def _names_next(before2: Column, before: Column) -> Column:
    """The words before a word end in a key-like name and a sign."""
    return _ends_in_sign(before) & (
        before.rlike(_NAME + _SIGN + "$") | (before.rlike(f"^{_SIGN}$") & before2.rlike(_NAME + "$"))
    )


def _assigns(word: Column) -> Column:
    """A word may hold an assignment to a key-like name; a cheap look first."""
    return (word.contains("=") | word.contains(":")) & word.rlike(_NAME + _SIGN)


def _bare(value: Column) -> Column:
    """A value without its quotes, or without a separator after it."""
    quote = F.substring(value, 1, 1)
    inside = F.split_part(F.substring(value, 2, 1 << 30), quote, F.lit(1))
    return F.when(quote.isin("\"", "'", "`"), inside).otherwise(F.rtrim(value, F.lit(",;")))


def _trimmed(value: Column) -> Column:
    """A value without quotes, brackets and marks around it."""
    return F.rtrim(F.ltrim(value, F.lit("\"'`([{<")), F.lit("\"'`)]}>.,;:"))


def candidates(
    docs: DataFrame, id_column: str, text_column: str, path_column: str
) -> DataFrame:
    """(doc_id, path, word_position, part, finding, keyed, before2, before, word, after).

    ``word_position`` counts the white-space separated words of the text from 0, ``part``
    the candidates inside one word: its runs, then the values of key-like names that are no run.
    """
    text = F.col(f"`{text_column}`")
    named = text.rlike(_NAME + r"\s*+" + _SIGN)
    suspicious = docs.where((text.rlike("[0-9]") & text.rlike(_RUN)) | named).select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.coalesce(F.col(f"`{path_column}`"), F.lit("")).alias("path"),
        F.split(text, _BLANKS).alias("words"),
    )
    near = lambda at: F.coalesce(F.get("words", at), F.lit(""))
    placed = F.filter(
        F.transform("words", lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
        lambda x: ((F.length(x["w"]) >= LEAST_LENGTH) & x["w"].rlike("[0-9]"))
        | _assigns(x["w"])
        | _names_next(near(x["i"] - 2), near(x["i"] - 1)),
    )
    runs = F.filter(
        F.regexp_extract_all("word", F.lit(_RUN), F.lit(0)), lambda r: r.rlike("[0-9]")
    )
    unquoted = F.transform(F.split("word", _FURTHER), lambda p: F.rtrim(F.regexp_extract(p, _UNQUOTED, 1), F.lit(",;")))
    values = F.when(
        _assigns(F.col("word")),
        F.concat(F.regexp_extract_all("word", F.lit(_QUOTED), F.lit(1)), F.filter(unquoted, lambda v: v != "")),
    ).otherwise(F.array().cast("array<string>"))
    following = F.when(
        _names_next(F.col("before2"), F.col("before")) & ~F.col("word").rlike(f"^{_SIGN}$"),
        F.array(_bare(F.col("word"))),
    ).otherwise(F.array().cast("array<string>"))
    whole = F.filter(
        F.concat("values", following), lambda v: (v != "") & ~F.array_contains("runs", _trimmed(v))
    )
    parts = F.concat(
        F.transform("runs", lambda r: F.struct(r.alias("finding"), F.array_contains("named", r).alias("keyed"))),
        F.transform(F.array_distinct("whole"), lambda v: F.struct(v.alias("finding"), F.lit(True).alias("keyed"))),
    )
    # Neighbours go along before hits become rows: no row carries all words of its text.
    hits = F.transform(
        placed,
        lambda x: F.struct(
            x["i"].alias("word_position"), near(x["i"] - 2).alias("before2"), near(x["i"] - 1).alias("before"),
            x["w"].alias("word"), near(x["i"] + 1).alias("after"),
        ),
    )
    return (
        suspicious.select("doc_id", "path", F.inline(hits))
        .withColumn("runs", runs)
        .withColumn("values", values)
        .withColumn("named", F.transform(F.concat("values", following), _trimmed))
        .withColumn("whole", whole)
        .select("*", F.posexplode(parts).alias("part", "found"))
        .select(
            "doc_id", "path", "word_position", "part", F.col("found.finding").alias("finding"),
            F.col("found.keyed").alias("keyed"), "before2", "before", "word", "after",
        )
    )


def dictionary(docs: DataFrame, text_column: str) -> DataFrame:
    """(entry): words of four letters or more that several documents have.

    Letters beside a digit are parts of keys, of which a large corpus repeats any short one.
    """
    found = F.regexp_extract_all(F.lower(f"`{text_column}`"), F.lit(r"(?<![a-z0-9])[a-z]{4,}(?![a-z0-9])"), F.lit(0))
    return (
        docs.select(F.explode(F.array_distinct(found)).alias("entry")).groupBy("entry").count()
        .where(F.col("count") >= LEAST_DOCUMENTS).select("entry")
    )


def _share(text: Column, kinds: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{kinds}]")) / F.length(text)


def _code(word: Column) -> Column:
    """A neighbouring word without its punctuation, hashed to a few values."""
    bare = F.regexp_replace(F.lower(word), r"[^\p{L}=:]+", "")
    return F.pmod(F.xxhash64(bare), F.lit(_HASHED))


def with_features(found: DataFrame, entries: DataFrame) -> DataFrame:
    c = F.col("finding")
    changes = lambda a, b: F.regexp_count(c, F.lit(f"[{a}](?=[{b}])"))
    runs = found.select("finding").distinct().withColumn(
        "entry", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("finding"), F.lit(r"[a-z]{4,}"), F.lit(0))))
    )
    covered = runs.join(entries, "entry").groupBy("finding").agg(
        F.sum(F.length("entry")).alias("covered")
    )
    return found.join(covered, "finding", "left").select(
        *found.columns,
        F.length(c).cast("double").alias("length"),
        _share(c, "0-9").alias("digit_share"),
        _share(c, "A-Za-z").alias("letter_share"),
        _share(c, "A-Z").alias("capital_share"),
        _share(c, "0-9a-fA-F").alias("hex_share"),
        ((changes("0-9", "A-Za-z") + changes("A-Za-z", "0-9")) / F.length(c)).alias("kind_changes"),
        ((changes("a-z", "A-Z") + changes("A-Z", "a-z")) / F.length(c)).alias("case_changes"),
        (F.size(F.array_distinct(F.split(c, ""))) / F.length(c)).alias("distinct_share"),
        (F.coalesce("covered", F.lit(0)) / F.length(c)).alias("dictionary_share"),
        F.pmod(F.xxhash64("path"), F.lit(_HASHED)).cast("double").alias("path_code"),
        _code(F.col("before")).cast("double").alias("before_code"),
        _code(F.col("before2")).cast("double").alias("before2_code"),
        _code(F.col("after")).cast("double").alias("after_code"),
        F.col("keyed").cast("double").alias("keyed_code"),
    )


def assigned_and_quoted() -> Column:
    """The label of a candidate: a quoted string after an equals sign or colon.

    Null (no label) for the value of a key-like name that is not quoted.
    """
    word, finding = F.col("word"), F.col("finding")
    quoted = word.rlike("[\"'][A-Za-z0-9_+/=\\-]{%d,}+[\"']" % LEAST_LENGTH) | (
        F.col("keyed") & F.exists(
            F.array(*[F.lit(q) for q in "\"'`"]),
            lambda q: word.contains(F.concat(q, finding, q)) | word.endswith(F.concat(q, finding)),
        )
    )
    sign = F.col("before").rlike("[=:]$") | word.rlike("[=:][\"'`]")
    return F.when(F.col("keyed") & ~quoted, None).otherwise((quoted & sign).cast("double"))


def _training_rows(labelled: DataFrame, size: int) -> DataFrame:
    """About ``size`` rows of each label; candidates that repeat place and string count once."""
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    keys = ["doc_id", "word_position", "part", "finding"]
    drawn = [
        bounded_sample(labelled.where(F.col("label") == label), keys, size, counts.get(label, 0)) for label in (0.0, 1.0)
    ]
    return drawn[0].unionByName(drawn[1]).select(*FEATURES, "label")


def scan_secrets(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path_column: str = "source",
    findings: DataFrame | None = None,
    sample_rows: int = SAMPLE_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per candidate: doc_id, word_position, part, finding, score, reported.

    ``findings(finding, label)`` are labelled findings (label 0.0 or 1.0); candidates with
    the same string train the forest. Without both labels no forest can be trained: score
    is null then and every candidate is reported. Null and empty texts have no candidates.
    Repeated rows give repeated candidates.
    """
    found = stored(candidates(docs, id_column, text_column, path_column), "secret-candidates")
    entries = stored(dictionary(docs, text_column), "dictionary")
    described = stored(with_features(found, entries), "secret-features")
    if findings is None:
        labelled = described.withColumn("label", assigned_and_quoted())
    else:
        labelled = described.join(findings.select("finding", "label").distinct(), "finding")
    columns = ["doc_id", "word_position", "part", "finding"]
    labelled = stored(_training_rows(labelled, sample_rows), "labelled-findings")
    if labelled.select("label").distinct().count() < 2:
        return described.select(
            *columns, F.lit(None).cast("double").alias("score"), F.lit(True).alias("reported")
        )
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(
        labelCol="label", numTrees=TREES, maxDepth=DEPTH, maxBins=_HASHED, seed=SEED
    ).fit(vector.transform(labelled.coalesce(4)))
    score = vector_to_array("probability")[1]
    return (
        forest.transform(vector.transform(described))
        .select(*columns, score.alias("score"))
        .withColumn("reported", F.col("score") >= threshold)
    )
