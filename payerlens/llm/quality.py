"""Quality classifier from weak labels.

Heuristic labellers look at each whole text and vote good, bad or nothing. They overlap and
contradict each other; expectation-maximisation over the counts of all vote patterns
estimates how accurate each one is and gives every pattern a posterior. A bounded sample
of documents with their posteriors trains a linear scorer on hashed byte n-grams and hashed
statistics, which scores all documents.

The pattern counts cover all documents and have at most 3 ** labellers rows, whatever the
input. The sample is bounded by ``sample_rows`` documents of any length, whose n-grams are
counted in tasks; only the training uses it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payerlens.llm.samples import MOST_COUNTED, bounded_sample, ngram_buckets, packed_counts, rows_in_blocks, unpacked_counts
from payerlens.llm.tables import pick
from payerlens.llm.textbytes import SEGMENT_BYTES, class_counts, column_bytes, row_sums, small_batches, words

BUCKETS = 1 << 16
SAMPLE_ROWS = 3000
SAMPLE_TASKS = 8
THRESHOLD = 0.5
GOOD, BAD, ABSTAIN = 1, 0, 2

_CODES = np.arange(256)
_LETTER = ((_CODES | 0x20) >= ord("a")) & ((_CODES | 0x20) <= ord("z")) | (_CODES >= 0x80)
_CAPITAL = (_CODES >= ord("A")) & (_CODES <= ord("Z"))
_MARK = np.isin(_CODES, [ord(c) for c in "#$%&*|<>{}[]\\^~!"])


class Labeller(NamedTuple):
    """Votes bad from ``bad`` on and good up to ``good`` (or the reverse, if bad < good)."""

    name: str
    statistic: str
    good: float
    bad: float

    def vote(self, value: np.ndarray) -> np.ndarray:
        sign = 1 if self.bad > self.good else -1
        out = np.full(len(value), ABSTAIN, np.int8)
        out[sign * value <= sign * self.good] = GOOD
        out[sign * value >= sign * self.bad] = BAD
        return out


LABELLERS = (
    Labeller("few_marks", "mark_share", 0.01, 0.04),
    Labeller("marked_words", "marks_per_word", 0.05, 0.30),
    Labeller("small_letters", "capital_share", 0.05, 0.30),
    Labeller("no_echo", "echo_share", 0.05, 0.15),
    Labeller("fresh_phrases", "repeated_phrase_share", 0.20, 0.50),
    Labeller("varied_words", "top_word_share", 0.16, 0.25),
    Labeller("no_stammer", "stammer_share", 0.01, 0.05),
)
STATISTICS = tuple(dict.fromkeys(x.statistic for x in LABELLERS))


def text_statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS for every text; an empty text has zeros."""
    raw, offsets = column_bytes(column)
    size = np.maximum(np.diff(offsets), 1)
    marks, letters, capitals = class_counts(raw, offsets, [_MARK, _LETTER, _CAPITAL]).T
    hashes, _, bounds = words(raw, offsets, lower=False)
    counts = np.maximum(np.diff(bounds), 1)
    same = np.zeros(len(hashes))
    same[1:] = hashes[1:] == hashes[:-1]
    same[bounds[:-1][bounds[:-1] < len(same)]] = 0
    echo = row_sums(same, bounds)
    thrice = np.zeros(len(hashes))  # the third repetition of a word, or a later one
    thrice[3:] = same[3:] * same[2:-1] * same[1:-2]
    stammer = row_sums(thrice, bounds)
    phrase, top = np.zeros(len(counts)), np.zeros(len(counts))
    pairs = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:] if len(hashes) else hashes
    for row, (start, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        n = end - start
        if n >= 20:  # shorter texts repeat nothing that says anything
            used = np.sort(pairs[start : end - 1])
            phrase[row] = 1 - (1 + np.count_nonzero(used[1:] != used[:-1])) / (n - 1)
            inside = np.sort(hashes[start:end])
            edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
            top[row] = np.diff(np.concatenate([[0], edges, [n]])).max() / n
    found = {
        "mark_share": marks / size,
        "marks_per_word": marks / counts,
        "capital_share": np.maximum(capitals - counts, 0) / np.maximum(letters, 1),
        "echo_share": echo / counts,
        "repeated_phrase_share": phrase,
        "top_word_share": top,
        "stammer_share": stammer / counts,
    }
    return np.stack([found[name] for name in STATISTICS], 1)


def vote_patterns(statistics: np.ndarray) -> np.ndarray:
    """The votes of all labellers as one number in base 3."""
    code = np.zeros(len(statistics), np.int64)
    for labeller in LABELLERS:
        code = 3 * code + labeller.vote(statistics[:, STATISTICS.index(labeller.statistic)])
    return code


def fit_accuracies(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior of being good for each vote pattern, by expectation-maximisation.

    Labellers are independent given the class; each has a chance of every vote in either
    class, smoothed by one vote. A bad vote names a fault and a good one only misses it, so
    the start trusts bad votes: each takes four fifths of the chance of being good.
    """
    n = len(LABELLERS)
    votes = np.stack([patterns // 3 ** (n - 1 - j) % 3 for j in range(n)], 1)
    posterior = np.clip(0.95 * 0.2 ** (votes == BAD).sum(1), 0.02, 0.98)
    for _ in range(rounds):
        weights = np.stack([counts * (1 - posterior), counts * posterior], 1)
        log = np.log((weights.sum(0) + 1) / (counts.sum() + 2))[None, :].repeat(len(votes), 0)
        for j in range(n):
            table = np.stack([weights[votes[:, j] == v].sum(0) for v in range(3)]) + 1
            log += np.log(table / table.sum(0))[votes[:, j]]
        before, posterior = posterior, 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -60, 60)))
        if np.abs(posterior - before).max() < 1e-9:
            break
    return posterior


def features(column: pa.Array, statistics: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of rows: (first row, row after, n-gram buckets at each byte, byte offsets).

    An n-gram that crosses into the next text is part of neither; its bucket is BUCKETS.
    """
    raw, offsets = column_bytes(column)
    for first, last in rows_in_blocks(offsets, SEGMENT_BYTES):
        own = offsets[first : last + 1] - offsets[first]
        part = raw[offsets[first] : offsets[last]]
        grams = np.full(len(part), BUCKETS, np.int64)
        found = ngram_buckets(part, 3, BUCKETS)
        grams[: len(found)] = found
        for back in (1, 2):
            at = own[1:] - back
            grams[at[at >= own[:-1]]] = BUCKETS
        yield first, last, grams, own


def statistic_buckets(statistics: np.ndarray) -> np.ndarray:
    """Hashed names of (statistic, step): eight steps between and beyond a labeller's limits."""
    out = []
    for j, name in enumerate(STATISTICS):
        labeller = next(x for x in LABELLERS if x.statistic == name)
        step = np.floor(4 * (statistics[:, j] - labeller.good) / (labeller.bad - labeller.good))
        step = np.clip(step, -2, 6).astype(np.int64) + 2
        out.append((step * 31 + j + 1) * 2654435761 % BUCKETS)
    return np.stack(out, 1)


def _mean_weights(weights: np.ndarray, grams: np.ndarray, own: np.ndarray) -> np.ndarray:
    values = weights[grams]
    used = row_sums((grams < BUCKETS).astype(np.float32), own)
    return row_sums(values, own) / np.maximum(used, 1)


class Scorer(NamedTuple):
    ngrams: np.ndarray  # one weight a bucket, and 0 for the n-grams across texts
    steps: np.ndarray
    bias: float

    def score(self, column: pa.Array, statistics: np.ndarray) -> np.ndarray:
        logit = self.bias + self.steps[statistic_buckets(statistics)].sum(1)
        for first, last, grams, own in features(column, statistics):
            logit[first:last] += _mean_weights(self.ngrams, grams, own)
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def _sample_rows(most_ngrams: int) -> Callable:
    """Vote pattern, statistic buckets and n-gram counts of each text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            text = batch.column("text")
            statistics = text_statistics(text)
            steps = [row.astype(np.int64).tobytes() for row in statistic_buckets(statistics)]
            counts = [
                packed_counts(grams[a:b], BUCKETS, most_ngrams)
                for _, _, grams, own in features(text, statistics)
                for a, b in zip(own[:-1], own[1:], strict=True)
            ]
            columns = [pa.array(steps, pa.binary()), *[pa.array([r[i] for r in counts], pa.binary()) for i in (0, 1)]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(vote_patterns(statistics)), *columns], ["pattern", "steps", "ids", "share"]
            )

    return rows


def train_scorer(
    rows: list[tuple[np.ndarray, np.ndarray]], steps: list[np.ndarray], targets: np.ndarray,
    epochs: int = 15, seed: int = 5,
) -> Scorer:
    """Logistic regression on soft targets by stochastic gradient steps (AdaGrad)."""
    ngrams, step_weights, bias = np.zeros(BUCKETS + 1), np.zeros(BUCKETS), 0.0
    seen_n, seen_s, seen_b = np.full(BUCKETS + 1, 1e-8), np.full(BUCKETS, 1e-8), 1e-8
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            ids, share = rows[i]
            logit = bias + step_weights[steps[i]].sum() + ngrams[ids] @ share
            error = 1 / (1 + np.exp(-np.clip(logit, -60, 60))) - targets[i]
            slope = error * share
            seen_n[ids] += slope**2
            ngrams[ids] -= 0.3 * slope / np.sqrt(seen_n[ids])
            seen_s[steps[i]] += error**2
            step_weights[steps[i]] -= 0.3 * error / np.sqrt(seen_s[steps[i]])
            seen_b += error**2
            bias -= 0.3 * error / np.sqrt(seen_b)
    return Scorer(ngrams.astype(np.float32), step_weights.astype(np.float32), float(bias))


def _pattern_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        code, n = np.unique(vote_patterns(text_statistics(batch.column("text"))), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["pattern", "n"])


def _score_rows(scorer: Scorer, posteriors: dict[int, float], threshold: float) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            text = batch.column("text")
            statistics = text_statistics(text)
            score = scorer.score(text, statistics)
            weak = [posteriors[p] for p in vote_patterns(statistics).tolist()]
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns |= {
                "weak_posterior": pa.array(weak, pa.float64()),
                "quality_score": pa.array(score, pa.float64()),
                "kept": pa.array(score >= threshold, pa.bool_()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return rows


def classify_quality(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    threshold: float = THRESHOLD,
    keep: list[str] | None = None,
    most_ngrams: int = MOST_COUNTED,
) -> DataFrame:
    """doc_id, weak_posterior, quality_score, kept for every row; or, with ``keep``, these
    three beside the input columns named there.

    Null counts as empty. An empty text has no bad sign but no letters either: it is
    scored like any other. Rows that repeat doc_id and text are drawn into the sample once and
    scored alike. The sample holds the ``most_ngrams`` most frequent n-grams of a text. Without
    any document the result is empty.
    """
    carried = {f"in_{i}": name for i, name in enumerate(keep or [])}
    slim = pick(docs, **({"doc_id": id_column, "text": text_column} | carried))
    counted = (
        slim.select("text").mapInArrow(_pattern_rows, "pattern bigint, n bigint")
        .groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    )
    patterns = np.array([r["pattern"] for r in counted], np.int64)
    counts = np.array([r["n"] for r in counted], np.float64)
    posterior = fit_accuracies(patterns, counts) if counted else np.zeros(0)
    posteriors = dict(zip(patterns.tolist(), posterior.tolist(), strict=True))

    # Rows that repeat or lack an id are drawn by their text as well.
    keyed = slim.select("text", F.xxhash64("doc_id", "text").alias("key"))
    sample = (
        bounded_sample(keyed, ["key"], sample_rows, int(counts.sum())).select("key", "text")
        .repartition(SAMPLE_TASKS, "key").sortWithinPartitions("key").select("text")
        .mapInArrow(_sample_rows(most_ngrams), "pattern bigint, steps binary, ids binary, share binary").toArrow()
    )
    drawn = {name: sample.column(name).to_pylist() for name in sample.column_names}
    rows = [unpacked_counts(*r) for r in zip(drawn["ids"], drawn["share"], strict=True)]
    steps = [np.frombuffer(r, np.int64) for r in drawn["steps"]]
    scorer = train_scorer(rows, steps, np.array([posteriors[p] for p in drawn["pattern"]]))

    added = "weak_posterior double, quality_score double, kept boolean"
    inputs = slim.columns
    schema = ", ".join(f"{n} {t}" for n, t in slim.dtypes) + ", " + added
    scored = slim.select(*inputs).mapInArrow(_score_rows(scorer, posteriors, threshold), schema)
    out = ["doc_id"] if keep is None else [F.col(k).alias(v) for k, v in carried.items()]
    return scored.select(*out, "weak_posterior", "quality_score", "kept")
