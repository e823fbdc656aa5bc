"""Toxicity: Levenshtein automata over a trie of learned terms, and context windows.

The lexicon is learned from labelled documents: words, and beginnings of words, that
toxic documents use far more often than others. A term's toxic uses count by their different
contexts (its neighbours), so copies of one passage count once; what a term weighs is the
lower bound of its log ratio. The terms form a trie. A Levenshtein automaton of each term,
intersected with the trie, runs as one automaton: a state is the set of trie nodes reached
with their numbers of edits. States are determinised when a text first reaches them, and a block
of words steps through them at once, letter by letter; most words are dead after three.

A hit weighs what the labelled documents say about its term at that number of edits. The words
around it decide how much of that is abuse: quotation marks and words of reporting take from
it, direct address adds. Abuse, its density and quoted use are the features of a logistic
regression on a histogram of all learning documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payerlens.llm.tables import hash_share, pick, stored
from payerlens.llm.textbytes import small_batches

LABELLED_ROWS = 100_000  # of each label, about: what the model is fitted on
LEXICON_TERMS = 2_000
LEAST_EVIDENCE = 1.5  # lower bound of the log ratio of a term's shares of toxic and of other texts' words
_CONTEXT_BITS = 63
STEM_LETTERS = (4, 7)  # beginnings of words that are tried as terms
THRESHOLD = 0.7
WINDOW_WORDS = 5
BLOCK_BYTES = 1 << 20
MOST_STATES = 20_000  # of the automaton in a task; it starts anew beyond that
QUOTED, REPORTED, ADDRESSED = 0.25, 0.5, 1.25  # what is left of a hit's weight
# --- fixed values: words of reporting and of direct address, in four languages ------------
REPORTING = (
    "said says wrote called calls quoted quote quotes word words term terms means meaning reported "
    "sagte sagt schrieb nannte zitiert zitat wort begriff bedeutet dit disait écrit appelé citation mot terme "
    "signifie dijo dice escribió llamó cita palabra término significa"
).split()
ADDRESS = "you your youre you're du dich dein deine ihr euch tu toi ton ta vous votre usted tú tus eres ustedes".split()
QUOTES = "\"'`«»„“”‚‘’‹›"
# ------------------------------------------------------------------------------------------
_INNER = "@$!*+'-"  # count as letters between two letters
_TABLE = 0x110000  # code points, each with a class


def edits_of(term: str) -> int:
    """Edits that a word may be away from a term: none for short ones, two for long ones."""
    return 0 if len(term) < 4 else 1 if len(term) < 8 else 2


class Term(NamedTuple):
    text: str
    stem: bool  # any word that begins with it is meant, without edits


class Automaton:
    """The Levenshtein automata of all terms, intersected with their trie and determinised.

    A state is a set of (trie node, edits); 0 is dead. ``match`` gives for each word the
    term with the fewest edits (ties to the smaller number), or -1.
    """

    def __init__(self, terms: list[Term], most_states: int = MOST_STATES):
        self.terms, self.most_states = terms, most_states
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.reach: list[int] = [0]  # most edits of any term below a node
        for number, term in enumerate(terms):
            edits, node = (0 if term.stem else edits_of(term.text)), 0
            self.reach[0] = max(self.reach[0], edits)
            for letter in term.text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.reach.append(0)
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], edits)
            self.ends[node].append(number)
        self.letters = sorted({c for t in terms for c in t.text})
        self.classes = np.zeros(_TABLE, np.int16)
        for i, letter in enumerate(self.letters, 1):
            self.classes[ord(letter)] = i
        self._restart()

    def _restart(self) -> None:
        self.states: dict[frozenset, int] = {frozenset(): 0}
        self.sets: list[tuple[frozenset, int]] = [(frozenset(), -1)]
        self.next = np.full((1024, len(self.letters) + 1), -1, np.int32)
        self.next[0] = 0
        self.found: list[int] = [-1]  # of a state: 4 * term + edits
        self.start = self._state(self._closed({(0, 0)}), -1)

    def _closed(self, nodes: set[tuple[int, int]]) -> frozenset:
        """With all nodes that deletions of a term's letters reach, each with its fewest edits only."""
        least: dict[int, int] = {}
        waiting = list(nodes)
        while waiting:
            node, edits = waiting.pop()
            if edits > self.reach[node] or least.get(node, 9) <= edits:
                continue
            least[node] = edits
            waiting += [(child, edits + 1) for child in self.children[node].values()]
        return frozenset(least.items())

    def _state(self, nodes: frozenset, stem: int) -> int:
        """``stem`` is the first stem that the word begins with: it stays found."""
        key = (nodes, stem)
        if key not in self.states:
            hits = [(e, t) for n, e in nodes for t in self.ends[n] if not self.terms[t].stem and e <= edits_of(self.terms[t].text)]
            if stem >= 0:
                hits.append((0, stem))
            if not nodes and stem < 0:
                return 0
            self.states[key] = len(self.sets)
            self.sets.append(key)
            best = min(hits, default=None)
            self.found.append(-1 if best is None else 4 * best[1] + best[0])
            if len(self.sets) > len(self.next):
                self.next = np.concatenate([self.next, np.full_like(self.next, -1)])
        return self.states[key]

    def _step(self, state: int, letter: int) -> int:
        nodes, stem = self.sets[state]
        text = self.letters[letter - 1] if letter else None
        out: set[tuple[int, int]] = set()
        for node, edits in nodes:
            out.add((node, edits + 1))  # a letter too many
            for own, child in self.children[node].items():
                out.add((child, edits + (own != text)))
                if own == text and edits == 0 and stem < 0:
                    stem = min((t for t in self.ends[child] if self.terms[t].stem), default=-1)
        return self._state(self._closed(out), stem)

    def match(self, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """4 * term + edits for each word of ``points`` (code points), -1 where none is near."""
        if len(self.sets) > self.most_states:
            self._restart()
        classes = self.classes[points]
        at, state = np.arange(len(starts)), np.full(len(starts), self.start, np.int32)
        out, place = np.full(len(starts), -1, np.int64), 0
        if not self.terms:
            return out
        while len(at):
            ended = sizes[at] == place
            if ended.any():
                out[at[ended]] = np.array(self.found, np.int64)[state[ended]]
                at, state = at[~ended], state[~ended]
            letter = classes[starts[at] + place]
            after = self.next[state, letter]
            missing = np.flatnonzero(after < 0)
            if len(missing):
                pairs = np.unique(state[missing].astype(np.int64) * len(self.next[0]) + letter[missing])
                for pair in pairs.tolist():
                    s, c = divmod(pair, len(self.next[0]))
                    to = self._step(s, c)
                    self.next[s, c] = to
                after = self.next[state, letter]
            alive = after > 0
            at, state, place = at[alive], after[alive], place + 1
        return out


class Tokens(NamedTuple):
    points: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    bounds: np.ndarray  # word offsets of the texts


def tokens(texts: list[str]) -> Tokens:
    """Words of lower-cased texts: letters and digits, and marks between two of them."""
    own = [t.lower() for t in texts]
    ends = np.concatenate([[0], np.cumsum([len(t) + 1 for t in own])]).astype(np.int64)
    points = np.frombuffer("\n".join([*own, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    small = points < 128
    letter = ~small | _ASCII_WORD[np.where(small, points, 0)]
    letter &= ~np.isin(points, _OTHER_MARKS)
    inner = small & _ASCII_INNER[np.where(small, points, 0)]
    if len(points) > 2:
        joined = inner[1:-1] & letter[:-2] & letter[2:]
        word = letter.copy()
        word[1:-1] |= joined
    else:
        word = letter
    edge = np.diff(np.concatenate([[0], word.astype(np.int8), [0]]))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return Tokens(points, starts, stops - starts, np.searchsorted(starts, ends))


_ASCII_WORD = np.array([chr(i).isalnum() for i in range(128)])
_ASCII_INNER = np.array([chr(i) in _INNER for i in range(128)])
_OTHER_MARKS = np.array(
    [ord(c) for c in QUOTES if ord(c) >= 128] + [0xA0, 0xA1, 0xBF, 0xB7, 0xAB, 0xBB, *range(0x2000, 0x2070), *range(0x3000, 0x3004), 0xFEFF],
    np.uint32,
)
_QUOTE_POINTS = np.array([ord(c) for c in QUOTES], np.uint32)


def _text(t: Tokens, i: int) -> str:
    return t.points[t.starts[i] : t.starts[i] + t.sizes[i]].tobytes().decode("utf-32-le", "surrogatepass")


def context_factor(t: Tokens, word: int, first: int, last: int) -> float:
    """How much of a hit is abuse, from the words around it (``first`` to ``last`` are its text's)."""
    start, stop = int(t.starts[word]), int(t.starts[word] + t.sizes[word])
    before, after = t.points[max(start - 2, 0) : start], t.points[stop : stop + 2]
    quoted = np.isin(before, _QUOTE_POINTS).any() and np.isin(after, _QUOTE_POINTS).any()
    near = [_text(t, i) for i in range(max(first, word - WINDOW_WORDS), min(last, word + WINDOW_WORDS + 1)) if i != word]
    out = QUOTED if quoted else 1.0
    if any(w in _REPORTING for w in near):
        out *= REPORTED
    return out * ADDRESSED if out == 1.0 and any(w in _ADDRESS for w in near) else out


_REPORTING, _ADDRESS = frozenset(REPORTING), frozenset(ADDRESS)


class Lexicon(NamedTuple):
    terms: list[Term]
    weights: np.ndarray  # (terms x 3 edits)


def _blocks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts in blocks of about BLOCK_BYTES; a longer text is alone."""
    block, first, size = [], 0, 0
    for i, text in enumerate(column):
        text = text.as_py() or ""
        if block and size + len(text) > BLOCK_BYTES:
            yield first, block
            block, first, size = [], i, 0
        block.append(text)
        size += len(text)
    if block:
        yield first, block


def text_features(automaton: Automaton, weights: np.ndarray, column: pa.Array) -> np.ndarray:
    """Of every text: abuse, abuse for 100 words, quoted use (weights of hits, summed up)."""
    out = np.zeros((len(column), 3))
    for first, texts in _blocks(column):
        t = tokens(texts)
        found = automaton.match(t.points, t.starts, t.sizes)
        hits = np.flatnonzero(found >= 0)
        value = weights[found[hits] >> 2, found[hits] & 3]
        counts = np.diff(t.bounds)
        for i, weight in zip(hits[value > 0].tolist(), value[value > 0].tolist(), strict=True):
            row = int(np.searchsorted(t.bounds, i, "right")) - 1
            factor = context_factor(t, i, int(t.bounds[row]), int(t.bounds[row + 1]))
            out[first + row, 0] += weight * factor
            out[first + row, 2] += weight * max(1 - factor, 0)
        own = slice(first, first + len(texts))
        out[own, 1] = 100 * out[own, 0] / np.maximum(counts, 1)
    return out


_STEPS = 4  # of a feature's logarithm


def binned(features: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(_STEPS * np.log1p(features)), 255).astype(np.int64)


def fit_regression(bins: np.ndarray, good: np.ndarray, bad: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights (three features, bias) by Newton steps on counts of (bins, label), lightly regularised."""
    x = np.concatenate([bins / _STEPS, np.ones((len(bins), 1))], 1)
    total = good + bad
    penalty = np.diag([0.01, 0.01, 0.01, 1e-4]) * max(total.sum() / 1000, 1.0)
    w = np.zeros(4)
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (bad - total * chance) - penalty @ w
        curve = (x * (total * chance * (1 - chance))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve + 1e-9 * np.eye(4), slope)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model(NamedTuple):
    lexicon: Lexicon
    regression: np.ndarray | None  # None: nothing could be learned
    share: float  # toxic ones among the labelled documents

    def score(self, automaton: Automaton, column: pa.Array) -> np.ndarray:
        if self.regression is None:
            return np.full(len(column), self.share)
        x = np.log1p(text_features(automaton, self.lexicon.weights, column))
        return 1 / (1 + np.exp(-np.clip(x @ self.regression[:3] + self.regression[3], -40, 40)))


def _uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each block with uses by label and, for toxic texts, a bit for each context."""
    for batch in small_batches(batches):
        toxic = np.array(batch.column("toxic").to_pylist(), bool)
        for first, texts in _blocks(batch.column("text")):
            t = tokens(texts)
            label = np.repeat(toxic[first : first + len(texts)], np.diff(t.bounds))
            counted: dict[str, list[int]] = {}
            before = 0
            data = t.points.tobytes()
            spans = zip((4 * t.starts).tolist(), (4 * (t.starts + t.sizes)).tolist(), label.tolist(), strict=True)
            rows = [(data[a:b], y) for a, b, y in spans]
            for i, (word, y) in enumerate(rows):
                own = counted.setdefault(word, [0, 0, 0])
                own[y] += 1
                if y:
                    after = rows[i + 1][0] if i + 1 < len(rows) else b""
                    own[2] |= 1 << (hash_of(before, after) % _CONTEXT_BITS)
                before = word
            words = [w.decode("utf-32-le", "surrogatepass").encode("utf-8", "replace").decode() for w in counted]
            columns = [pa.array(words, pa.string())]
            columns += [pa.array([c[i] for c in counted.values()], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "clean", "toxic", "contexts"])


def hash_of(before: bytes, after: bytes) -> int:
    """A stable hash of two neighbours (Python's own differs from process to process)."""
    out = 1469598103934665603
    for byte in (before or b"")[-24::4] + b"|" + after[:24:4]:
        out = (out ^ byte) * 1099511628211 & 0xFFFFFFFFFFFFFFFF
    return out >> 7


def _evidence(toxic_words: int, clean_words: int) -> Column:
    """Lower bound (two standard errors) of the log ratio of shares, toxic uses by context.

    The number of contexts is estimated from the share of free bits; a full map says no more
    than that they are many.
    """
    bits = F.bit_count("contexts")
    contexts = F.when(bits < _CONTEXT_BITS, -_CONTEXT_BITS * F.log(1 - bits / _CONTEXT_BITS)).otherwise(F.col("toxic"))
    toxic = F.least(F.col("toxic").cast("double"), contexts.cast("double")) + 0.5
    clean = F.col("clean") + 0.5
    ratio = F.log(toxic / float(max(toxic_words, 1))) - F.log(clean / float(max(clean_words, 1)))
    return ratio - 2 * F.sqrt(1 / toxic + 1 / clean)


def vocabulary(learning: DataFrame) -> DataFrame:
    """(word, clean, toxic, contexts): uses of every word of ``learning(text, toxic)``, stored."""
    counted = learning.mapInArrow(_uses, "word string, clean bigint, toxic bigint, contexts bigint")
    return stored(
        counted.groupBy("word").agg(
            F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.bit_or("contexts").alias("contexts")
        ),
        "toxicity-vocabulary",
    )


def learn_lexicon(words: DataFrame, most_terms: int = LEXICON_TERMS) -> Lexicon:
    """Terms and their weights by edits, from the uses of all words."""
    totals = words.agg(F.sum("clean"), F.sum("toxic")).first()
    clean_words, toxic_words = (int(v or 0) for v in totals)
    stems = (
        words.where(F.length("word") > STEM_LETTERS[0])
        .withColumn("size", F.explode(F.sequence(F.lit(STEM_LETTERS[0]), F.least(F.lit(STEM_LETTERS[1]), F.length("word") - 1))))
        .groupBy(F.substring(F.col("word"), F.lit(1), F.col("size")).alias("word"))
        .agg(
            F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.bit_or("contexts").alias("contexts"),
            F.count("*").alias("forms"),
        )
        .where("forms > 3").drop("forms")
    )
    either = words.where(F.length("word") > 2).withColumn("stem", F.lit(False)).unionByName(stems.withColumn("stem", F.lit(True)))
    chosen = (
        either.withColumn("evidence", _evidence(toxic_words, clean_words)).where(F.col("evidence") >= LEAST_EVIDENCE)
        # Bounded: the model's vocabulary, its most telling terms.
        .orderBy(F.desc("evidence"), "stem", "word").limit(most_terms)
        .select("word", "stem", "evidence").collect()
    )
    terms = [Term(r["word"], r["stem"]) for r in chosen]
    weights = np.zeros((len(terms), 3))
    if not terms:
        return Lexicon(terms, weights)
    weights[:, 0] = [r["evidence"] for r in chosen]
    # Words near a term say how much a misspelling of it means.
    near = words.mapInArrow(_near(terms), "hit bigint, clean bigint, toxic bigint").groupBy("hit").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    seen = {r["hit"]: (r["clean"], r["toxic"]) for r in near.collect()}  # 3 rows a term at most
    for i in range(len(terms)):
        for edits in (1, 2):
            clean, toxic = seen.get(4 * i + edits, (0, 0))
            log = np.log((toxic + 0.5) / max(toxic_words, 1)) - np.log((clean + 0.5) / max(clean_words, 1))
            prior = weights[i, 0] * 0.5**edits
            n = clean + toxic
            weights[i, edits] = max(0.0, (n * log + 4 * prior) / (n + 4))
    return Lexicon(terms, weights)


def _near(terms: list[Term]) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(terms)
        for batch in batches:
            words = batch.column("word").to_pylist()
            sizes = np.array([len(w) for w in words], np.int64)
            points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
            found = automaton.match(points, np.cumsum(sizes) - sizes, sizes)
            at = np.flatnonzero((found >= 0) & (found & 3 > 0))
            columns = [pa.array(found[at]), *[batch.column(c).take(pa.array(at)) for c in ("clean", "toxic")]]
            yield pa.RecordBatch.from_arrays(columns, ["hit", "clean", "toxic"])

    return rows


def _binned_rows(lexicon: Lexicon) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(lexicon.terms)
        for batch in small_batches(batches):
            bins = binned(text_features(automaton, lexicon.weights, batch.column("text")))
            columns = [pa.array(bins[:, i]) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("toxic")], ["a", "b", "c", "toxic"])

    return rows


def learning_rows(docs: DataFrame, labels: DataFrame, most_rows: int) -> DataFrame:
    """(text, toxic) of about ``most_rows`` labelled documents of each label, stored.

    The labels' doc_ids are drawn by their hash and are few enough to be sent to every
    task, so no text is shuffled.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = stored(known.select("doc_id", (F.col("toxic") >= 1).alias("toxic")), "toxicity-labels")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    drawn = [
        known.where((F.col("toxic") == y) & hash_share(F.col("doc_id"), min(1.0, most_rows / max(counts.get(y, 0), 1))))
        for y in (False, True)
    ]
    return stored(docs.join(F.broadcast(drawn[0].unionByName(drawn[1])), "doc_id").select("text", "toxic"), "toxicity-learning")


def fit_toxicity(docs: DataFrame, labels: DataFrame, most_rows: int = LABELLED_ROWS, most_terms: int = LEXICON_TERMS) -> Model:
    """A model from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``."""
    learning = learning_rows(docs, labels, most_rows)
    lexicon = learn_lexicon(vocabulary(learning), most_terms)
    found = (
        learning.mapInArrow(_binned_rows(lexicon), "a bigint, b bigint, c bigint, toxic boolean")
        .groupBy("a", "b", "c").agg(F.count_if(~F.col("toxic")).alias("good"), F.count_if("toxic").alias("bad"))
        .orderBy("a", "b", "c").collect()  # a histogram of bounded size
    )
    bins = np.array([[r["a"], r["b"], r["c"]] for r in found], float).reshape(-1, 3)
    good, bad = (np.array([r[c] for r in found], float) for c in ("good", "bad"))
    share = float(bad.sum() / max(good.sum() + bad.sum(), 1))
    if not bad.sum() or not good.sum():
        return Model(lexicon, None, share)
    return Model(lexicon, fit_regression(bins, good, bad), share)


def _scored(model: Model, threshold: float) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(model.lexicon.terms)
        for batch in small_batches(batches):
            score = model.score(automaton, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return rows


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = THRESHOLD,
    most_rows: int = LABELLED_ROWS,
    most_terms: int = LEXICON_TERMS,
) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted for every row.

    Learns from labelled rows that are not ``held_out`` (a condition on doc_id, null counts as
    false): about ``most_rows`` of each label, all uses of all their words. Null texts are
    empty; an empty text has the score of a text without hits. Where the labels hold one class only
    or none, the score is that class's share (0.0 without labels). Several labels of a doc_id count
    as toxic if one is. Rows that repeat a doc_id are scored each for itself.
    """
    slim = pick(docs, doc_id=id_column, text=text_column).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    known = pick(labels, doc_id="doc_id", toxic="toxic").withColumn("doc_id", F.col("doc_id").cast("long"))
    learned = slim.where("NOT held_out AND doc_id IS NOT NULL").select("doc_id", "text")
    model = fit_toxicity(learned, known.where(~F.coalesce(held_out, F.lit(False))), most_rows, most_terms)
    schema = "doc_id bigint, held_out boolean, score double, predicted int"
    return slim.select("doc_id", "held_out", "text").mapInArrow(_scored(model, threshold), schema)
