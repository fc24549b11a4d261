"""Toxicity scores from a lexicon, Levenshtein automata and the context of each hit.

The lexicon is learned from labelled rows: words, and stems of longer words, that toxic
documents use far more often than clean ones. Its words form a trie, which is intersected
with the Levenshtein automata of their edit limits; a swap of neighbouring letters is one edit.
Every different word of a text walks the trie, and the states it meets are kept for the words
that begin alike, so only states that texts need are ever made. So misspelled terms are found
as well as exact ones: one edit from 5 letters on, two from 9. Shorter terms and stems have no
edits, as too many clean words are one edit away. A word stays in the lexicon beside its stem.

Words are runs of letters, digits and the marks on them in all scripts; text written without spaces
(Chinese, Japanese, Thai) is not parted further, so its terms are whole runs or their beginnings.

Each hit is weighed in its context: between quotation marks or on a quoted line it counts as
quotation, elsewhere as abuse, and the densest window of words counts on its own. A logistic
regression over these figures gives the score.

Bounds: the lexicon and the regression are fitted on at most SAMPLE labelled rows, half each,
taken in the order of a hash of doc_id; the lexicon holds all terms that their figures
single out. Scoring is one pass over whole texts without a shuffle. A task keeps at most
AUTOMATON_BYTES of states and MEMO_WORDS words, starts anew beyond, and drops them at its end.
Quotation marks more than QUOTE_REACH characters apart are no pair: what stands between them counts as abuse.

Defined results: a null or empty text has no hits and gets the score of such texts; documents
in labels without a row in the documents are ignored, as are null labels; repeated rows are
scored each, and of rows with one doc_id one is learned from; without labels of both kinds every score is the (smoothed) share of label 1; an
empty table gives no rows; `scores` keeps the columns it is told to.
"""

from __future__ import annotations

import math
import unicodedata
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packedts.llm.batches import small_batches
from packedts.llm.components import stored

SAMPLE = 12_000
LEAST_DOCUMENTS = 3
LEAST_LOG_ODDS = 1.8
LEAST_SCORE = 7.0
STEMS = range(3, 10)
WINDOW = 40
QUOTE_REACH = 400
SLICE = 400
# What a worker holds while a task runs: packed states, each with its object and transitions, and words.
AUTOMATON_BYTES, STATE_BYTES = 48 << 20, 400
MEMO_WORDS = 100_000
MARKS = ("“”„«»‹›", '"' * 7)
FEATURES = ("words", "stems", "misspelled", "quoted", "window", "strongest", "density")
# What the regression is drawn towards where the sample says little.
PRIOR = np.array([0.5, 0.2, 0.1, 0.05, 0.3, 0.2, 0.1])


@dataclass(frozen=True)
class Term:
    """A word, or the stem of longer words, and its log odds."""

    text: str
    stem: bool
    weight: float

    @property
    def edits(self) -> int:
        """Edits that still count as the term: none for stems and short words."""
        return 0 if self.stem or len(self.text) < 5 else 1 if len(self.text) < 9 else 2


@dataclass(eq=False, slots=True)
class State:
    """What a word may have become so far, and the terms that end here (-1: none).

    places holds packed numbers (node, letter, edits): a node of the trie, the letter that must come next to
    complete a swap (0 outside of one), and the edits so far.
    """

    places: bytes
    exact: int
    close: int
    stem: int
    after: dict[int, State] = field(default_factory=dict)


class Automaton:
    """The lexicon trie intersected with the terms' Levenshtein automata, determinised as words need it."""

    def __init__(self, terms: list[Term]) -> None:
        self.terms = terms
        # letters by number; 0 stands for those that no term holds
        self.letters = {c: n for n, c in enumerate(sorted({c for t in terms for c in t.text}), 1)}
        self.children: list[dict[int, int]] = [{}]
        self.ends: dict[int, list[int]] = defaultdict(list)
        # edits that any term below a node allows
        self.allowed = [0]
        for number, term in enumerate(terms):
            node = 0
            self.allowed[0] = max(self.allowed[0], term.edits)
            for letter in map(self.letters.get, term.text):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                node = self.children[node][letter]
                self.allowed[node] = max(self.allowed[node], term.edits)
            self.ends[node].append(number)
        self._begin()

    @staticmethod
    def of(terms: list[Term]) -> Automaton:
        return Automaton(terms)

    def _begin(self) -> None:
        self.states: dict[bytes, State] = {}
        self.bytes = 0
        self.start = self._state({(0, 0): 0})

    def _state(self, places: dict[tuple[int, int], int]) -> State:
        """The state of these places and those that letters of the trie left out at an edit each lead to."""
        todo = [(node, edits) for (node, awaited), edits in places.items() if not awaited]
        while todo:
            node, edits = todo.pop()
            if places[node, 0] < edits:
                continue
            for child in self.children[node].values():
                if edits < self.allowed[child] and places.get((child, 0), 99) > edits + 1:
                    places[child, 0] = edits + 1
                    todo.append((child, edits + 1))
        key = array("q", sorted((node << 20 | awaited) << 2 | edits for (node, awaited), edits in places.items())).tobytes()
        if key not in self.states:
            ended = [(edits, term) for (node, awaited), edits in places.items() if not awaited for term in self.ends.get(node, ())]
            words = [(edits, term) for edits, term in ended if not self.terms[term].stem and edits <= self.terms[term].edits]
            # of several, the one with the fewest edits, then the first of the lexicon
            exact = min((term for edits, term in words if edits == 0), default=-1)
            stem = min((term for edits, term in ended if self.terms[term].stem and edits == 0), default=-1)
            self.states[key] = State(key, exact, min(words, default=(0, -1))[1], stem)
            self.bytes += len(key) + STATE_BYTES
        return self.states[key]

    def _after(self, state: State, letter: int) -> State:
        places: dict[tuple[int, int], int] = {}
        allowed, children = self.allowed, self.children
        for place in array("q", state.places):
            node, awaited, edits = place >> 22, place >> 2 & 0xFFFFF, place & 3
            if awaited:
                if awaited == letter and places.get((node, 0), 99) > edits:
                    places[node, 0] = edits
                continue
            if (child := children[node].get(letter)) is not None and edits <= allowed[child] and places.get((child, 0), 99) > edits:
                places[child, 0] = edits
            edits += 1
            if edits > allowed[node]:  # no term below allows another one
                continue
            if places.get((node, 0), 99) > edits:  # an extra letter
                places[node, 0] = edits
            for label, child in children[node].items():
                if label != letter and edits <= allowed[child]:
                    if places.get((child, 0), 99) > edits:
                        places[child, 0] = edits
                    swapped = children[child].get(letter)
                    if swapped is not None and edits <= allowed[swapped] and places.get((swapped, label), 99) > edits:
                        places[swapped, label] = edits
        state.after[letter] = self._state(places)
        return state.after[letter]

    def find(self, word: str) -> tuple[int, int] | None:
        """The term of a word and its kind: 0 the word itself, 1 a stem of it, 2 misspelled."""
        if self.bytes > AUTOMATON_BYTES:
            self._begin()
        state, stem = self.start, -1
        for left, letter in enumerate(word, 1 - len(word)):
            letter = self.letters.get(letter, 0)
            state = state.after.get(letter) or self._after(state, letter)
            if not state.places:
                break
            if left and state.stem >= 0:
                stem = state.stem
        if state.exact >= 0:
            return state.exact, 0
        if stem >= 0:
            return stem, 1
        return (state.close, 2) if state.close >= 0 else None


@dataclass
class Model:
    terms: list[Term]
    weights: np.ndarray
    bias: float


def prepared(text: Column) -> Column:
    """Lower case, with one form of quotation mark; null as empty."""
    return F.translate(F.lower(F.coalesce(text.cast("string"), F.lit(""))), *MARKS)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points stand in words: letters and digits of all scripts, and the vowel signs and accents on them."""
    marks = [c for c in range(0x110000) if unicodedata.category(chr(c)) in ("Mn", "Mc") and "VARIATION SELECTOR" not in unicodedata.name(chr(c), "")]
    letter = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    letter[marks] = True
    return letter


def words_of(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words of a text, the places where they begin, and all code points."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    edge = np.diff(np.concatenate([[0], letters()[points].view(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return list(map(text.__getitem__, map(slice, first.tolist(), last.tolist()))), first, points


class Reader:
    """Runs texts through the automaton and describes each by its features."""

    def __init__(self, terms: list[Term], automaton: Automaton) -> None:
        self.weight = np.array([t.weight for t in terms] + [0.0])

        class Memo(dict):
            """3 * term + kind of a word, or -1."""

            def __missing__(self, word: str) -> int:
                if len(self) >= MEMO_WORDS:
                    self.clear()
                hit = automaton.find(word)
                code = -1 if hit is None else 3 * hit[0] + hit[1]
                if len(word) < 64:
                    self[word] = code
                return code

        self.memo = Memo()

    def features(self, texts: list[str]) -> np.ndarray:
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        words, first, points = words_of("\n".join([*texts, ""]))
        ends = np.cumsum(sizes)
        doc = np.searchsorted(ends, first, "right")
        n_words = np.bincount(doc, minlength=len(texts))
        codes = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        word = np.flatnonzero(codes >= 0)
        term, kind = np.divmod(codes[word], 3)
        out = np.zeros((len(texts), len(FEATURES)))
        if len(word):
            quoted = self._quoted(points, ends, sizes)[first[word]]
            weight, of = self.weight[term], doc[word]
            abuse = np.where(quoted, 0.25, 1.0) * weight * np.where(kind == 2, 0.5, 1.0)
            for k in range(3):
                mine = (kind == k) & ~quoted
                out[:, k] = np.log1p(np.bincount(of[mine], weight[mine], minlength=len(texts)))
            out[:, 3] = np.log1p(np.bincount(of[quoted], minlength=len(texts)))
            # weight of the hits among the WINDOW words from a hit on, within its document
            total = np.append(0, np.cumsum(abuse))
            begin = np.cumsum(n_words) - n_words
            stop = np.minimum(word + WINDOW, (begin + n_words)[of])
            np.maximum.at(out[:, 4], of, np.log1p(total[np.searchsorted(word, stop)] - total[:-1]))
            np.maximum.at(out[:, 5], of, abuse)
            out[:, 6] = np.log1p(100 * np.bincount(of, abuse, minlength=len(texts)) / np.maximum(n_words, 20))
        return out

    def _quoted(self, points: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which characters stand between two quotation marks not too far apart, or on a line that starts with >."""
        edge = np.zeros(len(points) + 1, np.int32)
        marks = np.flatnonzero(points == ord('"'))
        of = np.searchsorted(ends, marks, "right")
        opens = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else of
        rank = np.arange(len(marks)) - np.repeat(opens, np.diff(np.append(opens, len(marks))))
        pairs = np.flatnonzero((rank[:-1] % 2 == 0) & (of[:-1] == of[1:]) & (np.diff(marks) <= QUOTE_REACH)) if len(marks) > 1 else []
        edge[marks[pairs]] += 1
        edge[marks[np.asarray(pairs, int) + 1]] -= 1
        lines = np.append(-1, np.flatnonzero(points == 10))
        starts = lines[:-1] + 1
        cited = points[starts] == ord(">") if len(starts) else np.zeros(0, bool)
        np.add.at(edge, starts[cited], 1)
        np.add.at(edge, lines[1:][cited], -1)
        return np.cumsum(edge[:-1]) > 0


# --- learning ----------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _term_counts(texts: DataFrame) -> DataFrame:
    """term, stem, toxic and clean: documents with the term, by label, from (text, toxic)."""
    schema = pa.schema([("term", pa.string()), ("stem", pa.bool_()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found = {w for w in words_of(text)[0] if len(w) >= 3}
                counts[toxic].update((w, False) for w in found)
                counts[toxic].update({(w[:k], True) for w in found for k in STEMS if len(w) > k})
            terms = list(counts[1].keys() | counts[0].keys())
            columns = [[t for t, _ in terms], [s for _, s in terms], [counts[1][t] for t in terms], [counts[0][t] for t in terms]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return (
        texts.mapInArrow(task, "term string, stem boolean, toxic long, clean long")
        .groupBy("term", "stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def _lexicon(counts: DataFrame, n_toxic: int, n_clean: int) -> list[Term]:
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    rows = (
        counts.where(F.col("toxic") >= LEAST_DOCUMENTS)
        .withColumn("odds", odds)
        .where((F.col("odds") >= LEAST_LOG_ODDS) & (F.col("odds") * F.sqrt("toxic") >= LEAST_SCORE))
        .orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "stem", F.desc(F.length("term")), "term")
        .collect()  # bounded by the words of the sample
    )
    chosen: list[Term] = []
    stems: set[str] = set()
    told_by: dict[str, int] = {}  # the documents of the most frequent chosen term that continues a stem
    for r in rows:
        # a stem is left out if a shorter one is in already, or a longer term says the same for most documents;
        # words stay beside their stems, which have no edits
        told = told_by.get(r.term, 0) if r.stem else 0
        rest = math.log((r.toxic - told + 0.5) / (n_toxic + 1)) - math.log((r.clean + 0.5) / (n_clean + 1))
        shorter = r.stem and any(r.term[:k] in stems for k in STEMS if k <= len(r.term))
        if not shorter and r.toxic - told >= LEAST_DOCUMENTS and rest >= LEAST_LOG_ODDS:
            chosen.append(Term(r.term, r.stem, float(r.odds)))
            if r.stem:
                stems.add(r.term)
            for k in STEMS:
                if k < len(r.term):
                    told_by[r.term[:k]] = max(told_by.get(r.term[:k], 0), r.toxic)
    return chosen


def _regression(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias by Newton's method, drawn towards PRIOR."""
    full = np.column_stack([x, np.ones(len(x))])
    share = (y.sum() + 1) / (len(y) + 2)
    centre = np.append(PRIOR, math.log(share / (1 - share)) - 0.5)
    strength = np.append(np.full(x.shape[1], 1.0), 0.01)
    w = centre.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        gradient = full.T @ (p - y) + strength * (w - centre)
        curve = (full * (p * (1 - p))[:, None]).T @ full + np.diag(strength)
        step = np.linalg.solve(curve, gradient)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows of docs that are not held out, at most SAMPLE of them."""
    small_batches(docs.sparkSession)
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id", F.lit(5)), "toxic")
        .limit(SAMPLE)  # bounded, so it may be broadcast
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), prepared(F.col("text")).alias("text"))
    sample = texts.join(F.broadcast(known), "doc_id").withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(2)))
    # of rows with one doc_id one teaches, however often it is repeated
    one = Window.partitionBy("doc_id", "toxic").orderBy(F.xxhash64("text"))
    sample = stored(sample.withColumn("n", F.row_number().over(one)).where("n = 1").drop("n"), "labelled")
    sizes = {(r.half, r.toxic): r["count"] for r in sample.groupBy("half", "toxic").count().collect()}
    n = [[sizes.get((half, toxic), 0) for toxic in (0, 1)] for half in (0, 1)]
    terms = _lexicon(_term_counts(sample.where("half = 0").select("text", "toxic")), n[0][1], n[0][0]) if all(n[0]) else []
    rows = described(sample.where("half = 1").select("text", "toxic"), terms).select("toxic", "features").collect()
    y = np.array([r.toxic for r in rows], float)
    if terms and 0 < y.sum() < len(y):
        return Model(terms, *_regression(np.array([r.features for r in rows]), y))
    toxic, total = n[0][1] + n[1][1], sum(map(sum, n))
    share = (toxic + 1) / (total + 2)
    return Model(terms, PRIOR * 4, min(-1.0, math.log(share / (1 - share))))


# --- scoring -----------------------------------------------------------------------------


def described(texts: DataFrame, terms: list[Term]) -> DataFrame:
    """The rows of texts with features in place of text, which is prepared."""
    kept = [f for f in texts.schema.fields if f.name != "text"]
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "features array<double>"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(terms, Automaton.of(terms))  # gone with the task
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                features = pa.array(list(reader.features(part.column("text").to_pylist())), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), features], names=[*(f.name for f in kept), "features"])

    return texts.mapInArrow(task, ddl)


def scores(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """row, a struct of the columns named in keep, and score, for every row of docs."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.struct(*keep).alias("row"), prepared(F.col("text")).alias("text"))
    logit = F.lit(model.bias)
    for k, w in enumerate(model.weights):
        logit = logit + F.lit(float(w)) * F.col("features")[k]
    return described(texts, model.terms).select("row", (1 / (1 + F.exp(-logit))).alias("score"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scores(docs, model, "doc_id").select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
