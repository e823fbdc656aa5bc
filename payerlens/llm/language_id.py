"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its byte n-grams (3 and 4 bytes of lower-cased text in
which all but letters is one blank); a linear layer and softmax give the languages. Both are
trained in numpy by stochastic gradient descent. The temperature and the threshold of
rejection are calibrated on a part of the training sample that the descent does not see.

Training uses a bounded sample: about ``sample_rows`` labelled documents of any length, evenly
over languages and at least one of each; if there are more languages than that (a column that
holds something else), the ``sample_rows`` most frequent ones are learned. Tasks count
their n-grams, so the driver gets bounded counts instead of texts. Prediction reads every whole text; since
the mean and the linear layer commute, each n-gram bucket carries its class scores only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payerlens.llm.samples import LETTERS, MOST_COUNTED, ngram_buckets, packed_counts, rows_in_blocks, unpacked_counts
from payerlens.llm.tables import pick, stored
from payerlens.llm.textbytes import SEGMENT_BYTES, column_bytes, row_sums, small_batches

WIDTHS = (3, 4)
BUCKETS = 1 << 16
DIMENSION = 8
SAMPLE_ROWS = 2000
_HASHES = 1 << 40
UNKNOWN = "und"
REJECT_RATE = 0.01  # share of calibration documents that may be rejected


class Model(NamedTuple):
    languages: list[str]
    scores: np.ndarray  # (buckets + 1) x languages or dimensions; the last row is for n-grams to skip
    layer: np.ndarray | None  # dimensions x languages, where there are more languages than dimensions
    bias: np.ndarray
    temperature: float
    threshold: float

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Class index and calibrated probability of every text."""
        raw, offsets = column_bytes(column)
        best, top = np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1)
        for start, end in rows_in_blocks(offsets, SEGMENT_BYTES):
            for first in range(start, end, 256):
                last = min(first + 256, end)
                logits = _mean_rows(self.scores, raw, offsets[first : last + 1])
                logits = logits if self.layer is None else logits @ self.layer
                logits = (logits + self.bias) / self.temperature
                chance = np.exp(logits - logits.max(1, keepdims=True))
                chance /= chance.sum(1, keepdims=True)
                best[first:last] = chance.argmax(1)
                top[first:last] = chance.max(1)
        return best, top


def _grams(part: np.ndarray, own: np.ndarray, width: int) -> np.ndarray:
    """Buckets of the n-grams of a block of rows; BUCKETS where one would leave its row."""
    out = np.full(len(part), BUCKETS, np.int64)
    found = ngram_buckets(part, width, BUCKETS)
    out[: len(found)] = found
    for back in range(1, width):
        at = own[1:] - back
        out[at[at >= own[:-1]]] = BUCKETS
    blank = part == 0x20  # n-grams that begin with two blanks say nothing
    out[:-1][blank[:-1] & blank[1:]] = BUCKETS
    return out


def _mean_rows(scores: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    own = offsets - offsets[0]
    part = LETTERS[raw[offsets[0] : offsets[-1]]]
    total = np.zeros((len(own) - 1, scores.shape[1]))
    used = np.zeros(len(own) - 1)
    step = max(1024, 4 * SEGMENT_BYTES // scores.shape[1])
    for width in WIDTHS:
        grams = _grams(part, own, width)
        used += row_sums(grams < BUCKETS, own)
        for start in range(0, len(part), step):
            end = min(start + step, len(part))
            first = np.searchsorted(own, start, "right") - 1
            last = np.searchsorted(own, end, "left")
            at = np.clip(own[first : last + 1], start, end) - start
            full = np.flatnonzero(at[1:] > at[:-1])
            total[first + full] += np.add.reduceat(scores[grams[start:end]], at[full], axis=0)
    return total / np.maximum(used, 1)[:, None]


def _counted(most_ngrams: int) -> Callable:
    """Language and n-gram counts of each text."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            raw, offsets = column_bytes(batch.column("text"))
            rows = []
            for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                part = LETTERS[raw[start:end]]
                own = np.array([0, len(part)])
                grams = np.concatenate([_grams(part, own, w) for w in WIDTHS]) if len(part) else np.zeros(0, np.int64)
                rows.append(packed_counts(grams, BUCKETS, most_ngrams))
            columns = [pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), *columns], ["lang", "ids", "share"])

    return counted


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[str], epochs: int = 4, rate: float = 0.1, seed: int = 3) -> Model:
    """Fits embeddings and softmax on n-gram shares; every tenth text of a language calibrates instead."""
    languages = sorted(set(labels))
    places = {x: i for i, x in enumerate(languages)}
    target = np.array([places[x] for x in labels])
    order = np.random.default_rng(seed)
    embeddings = order.uniform(-1, 1, (BUCKETS, DIMENSION)) / DIMENSION
    layer, bias = order.normal(0, 1, (DIMENSION, len(languages))), np.zeros(len(languages))
    seen_e, seen_l, seen_b = np.full(BUCKETS, 1e-12), np.full(layer.shape, 1e-8), np.full(len(bias), 1e-8)
    seen, held = dict.fromkeys(labels, 0), []
    for i, label in enumerate(labels):
        seen[label] += 1
        if seen[label] % 10 == 0:  # so every language is learned from
            held.append(i)
    if len(rows) < 20 or not held:
        learning, held = list(range(len(rows))), list(range(0, len(rows), 10))
    else:
        learning = sorted(set(range(len(rows))) - set(held))
    steps, done = epochs * len(learning), 0
    for _ in range(epochs):
        for i in order.permutation(learning):
            ids, share = rows[i]
            if not len(ids):
                continue
            pace = rate * (1 - done / steps)
            done += 1
            hidden = share @ embeddings[ids]
            logits = hidden @ layer + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[target[i]] -= 1
            back = layer @ chance
            # AdaGrad: each bucket, however rare, moves by steps of about the same size.
            slope = np.outer(hidden, chance)
            seen_l += slope**2
            layer -= pace * slope / np.sqrt(seen_l)
            seen_b += chance**2
            bias -= pace * chance / np.sqrt(seen_b)
            seen_e[ids] += share**2 * (back @ back)
            embeddings[ids] -= pace * np.outer(share / np.sqrt(seen_e[ids]), back)
    few = len(languages) <= DIMENSION
    scores = np.zeros((BUCKETS + 1, len(languages) if few else DIMENSION), np.float32)
    scores[:-1] = embeddings @ layer if few else embeddings
    means = np.array([share @ scores[ids] for ids, share in (rows[i] for i in held)])
    logits = (means if few else means @ layer) + bias
    best, temperature = np.inf, 1.0
    for candidate in np.geomspace(0.05, 20, 60):  # least negative log-likelihood
        z = logits / candidate
        z = z - z.max(1, keepdims=True)
        log = z - np.log(np.exp(z).sum(1, keepdims=True))
        loss = -log[np.arange(len(held)), target[held]].mean()
        if loss < best:
            best, temperature = loss, float(candidate)
    z = logits / temperature
    chance = np.exp(z - z.max(1, keepdims=True))
    top = (chance / chance.sum(1, keepdims=True)).max(1)
    threshold = float(min(np.quantile(top, REJECT_RATE), 0.9))
    return Model(languages, scores, None if few else layer, bias, temperature, threshold)


def _predicted(model: Model) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.languages, object)
        for batch in batches:
            best, chance = model.predict(batch.column("text"))
            lettered = np.array(batch.column("lettered").to_pylist(), bool)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(np.where(lettered, names[best], UNKNOWN), pa.string()),
                    pa.array(np.where(lettered, chance, 0.0), pa.float64()),
                    pa.array(lettered & (chance >= model.threshold), pa.bool_()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "accepted"],
            )

    return rows


def fit_language_model(
    labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, most_ngrams: int = MOST_COUNTED
) -> Model | None:
    """A model from ``labelled(doc_id, text, lang)``: texts with letters and a language. None without any."""
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "text", "lang", F.pmod(F.xxhash64("doc_id", "text"), F.lit(_HASHES)).alias("place")
    )
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    counts = stored(counts, "language-counts")
    languages = counts.count()
    if not languages:
        return None
    if languages > sample_rows:
        counts = stored(counts.orderBy(F.desc("n"), "lang").limit(sample_rows), "learned-languages")
    each = max(sample_rows / languages, 1.0)
    # The row of smallest hash is in whatever the rate.
    limits = counts.select(
        "lang", F.greatest("first", (F.lit(_HASHES) * F.least(F.lit(1.0), each / F.col("n"))).cast("long")).alias("most")
    )
    sample = usable.join(limits, "lang").where("place <= most").dropDuplicates(["lang", "place"])
    table = sample.select("lang", "text").mapInArrow(_counted(most_ngrams), "lang string, ids binary, share binary").toArrow()
    found = sorted(zip(*[table.column(c).to_pylist() for c in ("lang", "ids", "share")], strict=True))
    order = np.random.default_rng(1).permutation(len(found))
    return train([unpacked_counts(*found[i][1:]) for i in order], [found[i][0] for i in order])


def identify_languages(
    docs: DataFrame,
    held_out: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    **sampling,
) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted for every row.

    Learns from rows that are not ``held_out`` (a condition on doc_id, null counts as false)
    and have text and language, however long the text and rare the language. Texts that are null or have no letter get ``und``, 0.0 and are not accepted.
    ``accepted`` is false as well where the calibrated probability is below the threshold.
    Where nothing can be learned from, every row gets ``und``, 0.0 and is not accepted. Repeated rows are
    learned from once and labelled each. With more languages than ``sample_rows`` the rarest are not learned.
    """
    slim = pick(docs, doc_id=id_column, text=text_column, lang=language_column).withColumn(
        "held_out", F.coalesce(held_out, F.lit(False))
    )
    schema = (
        f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, held_out boolean, "
        "lang_pred string, score double, accepted boolean"
    )
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = slim.select("doc_id", "text", "held_out", lettered.alias("lettered"))
    learned = slim.where("NOT held_out AND doc_id IS NOT NULL")
    model = fit_language_model(learned, **sampling)
    if model is None:
        return rows.select(
            "doc_id",
            "held_out",
            F.lit(UNKNOWN).alias("lang_pred"),
            F.lit(0.0).alias("score"),
            F.lit(False).alias("accepted"),
        )
    return rows.mapInArrow(_predicted(model), schema)
