"""Language of a text from averaged embeddings of hashed subwords and a linear softmax.

Every text is lower-cased and cut into words, runs of letters and of the marks on them; the
subwords are all runs of 2 to 4 characters of a word with a blank on either side. A subword is
hashed to one of `buckets` embeddings, a text is the average of the embeddings of all its
subwords, and a linear softmax on that average gives the languages their shares. Embeddings and
softmax are trained together by stochastic gradient descent in numpy, one text a step, in turn
as a whole and as a handful of its subwords, so that short texts are known too.

Scores are calibrated on labelled texts that the descent never saw: a temperature makes the
share of the best language its chance of being right, and the least score at which at most
`error` of the accepted ones were wrong is where rejection begins (column accepted).

Bounds: learned from at most `sample` labelled rows, spread evenly over at most `languages`
languages, the most frequent ones (but LEAST rows of each); a row teaches at most `subwords` different
subwords, a seeded choice of all in its text. The model has buckets x width numbers, whatever the input. Predicting
is one pass over whole texts, in steps of STEP characters, without a shuffle.

Defined results: a null text, and one without a letter, is UNKNOWN with score 0 and not accepted,
and so is every text if no language is known; rows without doc_id are predicted but not
learned from, and of rows with one doc_id and language one teaches; repeated rows are predicted
each; a tie goes to the first language in code-point order; an empty table gives no rows;
`predictions` keeps the columns it is told to.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packedts.llm.batches import small_batches

STEP = 1 << 17
ORDERS = (2, 3, 4)
OVERLAP = max(ORDERS) - 1
UNKNOWN = "und"
LEAST = 20
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
FINISH = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Training:
    """Size of the model, of what it is learned from, and how."""

    sample: int = 3000
    languages: int = 256
    buckets: int = 1 << 16  # a power of two, 2 ** 16 at most
    width: int = 16
    subwords: int = 8192
    epochs: int = 5
    rate: float = 0.4
    error: float = 0.02
    seed: int = 11


@dataclass(frozen=True)
class Model:
    """Languages, the embeddings, the softmax on them, and the calibration."""

    languages: tuple[str, ...]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least_score: float = math.inf

    def logits(self, average: np.ndarray) -> np.ndarray:
        return average @ self.weights + self.bias

    def shares(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


# --- subwords ----------------------------------------------------------------------------


@lru_cache(maxsize=1)
def characters() -> tuple[np.ndarray, np.ndarray]:
    """Which code points are letters, and which stand in words: letters and the marks on them."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    marks = np.fromiter((unicodedata.category(chr(c)) in ("Mn", "Mc") for c in range(0x110000)), bool, 0x110000)
    return letter, letter | marks


def pieces_of(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Code points of the texts in runs of bounded length: points, and where each piece begins and its text's number.

    A long text is several pieces, each with the next characters, so that every subword stands in
    just one of them; the end of a text is marked by a line end.
    """
    held: list[str] = []
    of: list[int] = []
    size = 0

    def run() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        begins = np.cumsum([0, *map(len, held[:-1])])
        points = np.frombuffer("".join(held).encode("utf-32-le", "surrogatepass"), "<u4")
        return points, begins, np.array(of)

    for number, text in enumerate(texts):
        padded = f"\n{text or ''}\n"
        for lo in range(0, max(1, len(padded) - 1), STEP):
            held.append(padded[lo : lo + STEP + OVERLAP])
            of.append(number)
            size += len(held[-1])
            if size >= STEP:
                yield run()
                held, of, size = [], [], 0
    if held:
        yield run()


def subwords(points: np.ndarray, begins: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every subword of a run of pieces, and the number of its piece."""
    inside = characters()[1][points]
    codes = np.where(inside, points, 0).astype(np.uint64)
    ends = np.append(begins[1:], len(points))
    # a subword begins STEP characters into its piece at most; the last character of a piece begins none
    offset = np.arange(len(points)) - np.repeat(begins, ends - begins)
    starts = offset < STEP
    starts[ends - 1] = False
    found, of = [], []
    hashed = codes * FACTORS[0]
    middle = np.ones(len(points), bool)
    for order in range(2, max(ORDERS) + 1):
        n = len(points) - order + 1
        if n <= 0:
            break
        hashed = hashed[:n] + codes[order - 1 :] * FACTORS[order - 1]
        edge = inside[:n] | inside[order - 1 :] if order == 2 else True
        middle = middle[:n] if order == 2 else middle[:n] & inside[order - 2 : order - 2 + n]
        if order in ORDERS:
            at = np.flatnonzero(middle & starts[:n] & edge)
            h = (hashed[at] + np.uint64(order)) * FINISH
            h ^= h >> np.uint64(32)
            h *= FINISH
            found.append((h >> np.uint64(48)).astype(np.int64) & (buckets - 1))
            of.append(np.searchsorted(begins, at, "right") - 1)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bucket, piece = np.concatenate(found), np.concatenate(of)
    order = np.argsort(piece, kind="stable")
    return bucket[order], piece[order]


def averages(texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The average of table's rows over each text's subwords, their number, and whether it has a letter."""
    sums = np.zeros((len(texts), table.shape[1]))
    counts = np.zeros(len(texts), np.int64)
    letters = np.zeros(len(texts), bool)
    for points, begins, of in pieces_of(texts):
        bucket, piece = subwords(points, begins, len(table))
        if len(bucket):
            at = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            np.add.at(sums, of[piece[at]], np.add.reduceat(table[bucket], at, axis=0))
            counts += np.bincount(of[piece], minlength=len(texts))
        letters[of[np.logical_or.reduceat(characters()[0][points], begins)]] = True
    return sums / np.maximum(counts, 1)[:, None], counts, letters


# --- learning ----------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, training: Training) -> DataFrame:
    """lang, doc_id, text and part (0 to calibrate with, else to learn from): a bounded, even sample of labelled rows.

    Which rows are taken is decided on ids and languages alone: a rate per language first, which
    leaves about twice as many as needed wherever they lie, then an exact number of them.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    known = known.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "lang").limit(training.languages)
    sizes = sizes.withColumn("each", F.greatest(F.lit(LEAST), F.floor(training.sample / F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))))))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(training.seed)), F.lit(1 << 30))
    # three deviations above twice the number that is wanted
    rate = (2 * F.col("each") + 3 * F.sqrt(2 * F.col("each")) + 10) / F.col("rows")
    drawn = (
        known.select("lang", "doc_id")
        .join(F.broadcast(sizes), "lang")  # at most `languages` rows
        .withColumn("draw", draw)
        .where(F.col("draw") < rate * (1 << 30))
        .select("lang", "doc_id", "draw", "each")
        .distinct()
    )
    in_turn = Window.partitionBy("lang").orderBy("draw", "doc_id")
    chosen = drawn.withColumn("n", F.row_number().over(in_turn)).where("n <= each").select("lang", "doc_id")
    one = Window.partitionBy("lang", "doc_id").orderBy(F.xxhash64("text"))
    taught = known.join(F.broadcast(chosen), ["lang", "doc_id"]).withColumn("n", F.row_number().over(one)).where("n = 1")
    return taught.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(training.seed + 1)), F.lit(4)))


def _taught(sample: DataFrame, training: Training) -> list[tuple[str, int, np.ndarray, np.ndarray]]:
    """lang, part, buckets and how often each occurs, of every text of the sample that has subwords."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("part", pa.int64()), ("buckets", pa.binary()), ("counts", pa.binary())])
    buckets, most, seed = training.buckets, training.subwords, training.seed

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, lang, part, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "part", "text"))):
                counts = np.zeros(buckets, np.int64)
                for points, begins, _ in pieces_of([text]):
                    counts += np.bincount(subwords(points, begins, buckets)[0], minlength=buckets)
                held = np.flatnonzero(counts)
                if len(held) > most:
                    held = np.sort(np.random.default_rng([seed, doc_id % (1 << 62)]).choice(held, most, replace=False))
                if len(held):
                    rows.append((doc_id, lang, part, held.astype("<u2").tobytes(), counts[held].astype("<f4").tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    text = F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text")
    found = sample.select("doc_id", "lang", "part", text).mapInArrow(task, "doc_id long, lang string, part long, buckets binary, counts binary")
    rows = sorted(found.toArrow().to_pylist(), key=lambda r: (r["lang"], r["doc_id"]))
    return [(r["lang"], r["part"], np.frombuffer(r["buckets"], "<u2").astype(np.int64), np.frombuffer(r["counts"], "<f4").astype(float)) for r in rows]


def _descend(examples: list[tuple[int, np.ndarray, np.ndarray]], languages: tuple[str, ...], training: Training) -> Model:
    """Embeddings and softmax by stochastic gradient descent."""
    rng = np.random.default_rng(training.seed)
    table = rng.uniform(-1, 1, (training.buckets, training.width)) / training.width
    weights = rng.normal(0, 1, (training.width, len(languages))) / math.sqrt(training.width)
    bias = np.zeros(len(languages))
    steps, step = max(1, 2 * training.epochs * len(examples)), 0
    for _ in range(training.epochs):
        for number in rng.permutation(2 * len(examples)):
            label, buckets, counts = examples[number // 2]
            if number % 2:  # a handful of the subwords
                take = rng.choice(len(buckets), min(len(buckets), int(rng.integers(4, 64))), replace=False)
                buckets, counts = buckets[take], counts[take]
            share = counts / counts.sum()
            average = share @ table[buckets]
            z = average @ weights + bias
            wrong = np.exp(z - z.max())
            wrong /= wrong.sum()
            wrong[label] -= 1
            rate = training.rate * (1 - step / steps)
            back = weights @ wrong
            weights -= rate * np.outer(average, wrong)
            bias -= 0.1 * rate * wrong
            # normalised by the length of the text's vector: a step moves the average alike for short and long texts
            table[buckets] -= (rate / (share @ share)) * share[:, None] * back
            step += 1
    return Model(languages, table, weights, bias)


def _calibrated(model: Model, examples: list[tuple[int, np.ndarray, np.ndarray]], training: Training) -> Model:
    """The model with the temperature that makes scores chances, and the least score that is accepted."""
    if not examples:
        return model
    rng = np.random.default_rng(training.seed + 1)
    averages, labels = [], []
    for label, buckets, counts in examples:
        few = rng.choice(len(buckets), min(len(buckets), int(rng.integers(8, 64))), replace=False)
        for b, c in ((buckets, counts), (buckets[few], counts[few])):
            averages.append((c / c.sum()) @ model.embeddings[b])
            labels.append(label)
    z, y = model.logits(np.array(averages)), np.array(labels)

    def loss(log_temperature: float) -> float:
        s = z / math.exp(log_temperature)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    lo, hi = -3.0, 3.0
    golden = (math.sqrt(5) - 1) / 2
    while hi - lo > 1e-4:
        a, b = hi - golden * (hi - lo), lo + golden * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    model = Model(model.languages, model.embeddings, model.weights, model.bias, math.exp((lo + hi) / 2))
    shares = model.shares(z)
    score, wrong = shares.max(axis=1), shares.argmax(axis=1) != y
    order = np.argsort(-score, kind="stable")
    held = (np.cumsum(wrong[order]) + 1) / (np.arange(len(order)) + 2) <= training.error
    # equal scores are accepted together
    held &= np.append(score[order][1:] < score[order][:-1], True)
    least = float(score[order][np.flatnonzero(held)[-1]]) if held.any() else math.inf
    return Model(model.languages, model.embeddings, model.weights, model.bias, model.temperature, least)


def learn(docs: DataFrame, training: Training | None = None) -> Model:
    """A model of the languages that rows of docs (doc_id, text, lang) are labelled with, held-out rows aside."""
    small_batches(docs.sparkSession)
    training = training or Training()
    taught = _taught(_sample(docs, training), training)
    languages = tuple(sorted({lang for lang, part, _, _ in taught if part}))
    number = {lang: k for k, lang in enumerate(languages)}
    examples = [(number[lang], part, b, c) for lang, part, b, c in taught if lang in number]
    if not languages:
        return Model((), np.zeros((training.buckets, training.width)), np.zeros((training.width, 0)), np.zeros(0))
    model = _descend([(y, b, c) for y, part, b, c in examples if part], languages, training)
    return _calibrated(model, [(y, b, c) for y, part, b, c in examples if not part], training)


# --- predicting --------------------------------------------------------------------------


def predictions(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """row, a struct of the columns named in keep, lang_pred, score and accepted, for every row of docs."""
    # the softmax is linear, so averaging its part of each embedding is the same, and less where languages are few
    folded = len(model.languages) <= model.embeddings.shape[1]
    table = model.embeddings @ model.weights if folded else model.embeddings
    names = np.array([*model.languages, UNKNOWN], object)

    def predict(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        average, counts, letters = averages(texts, table)
        if not model.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        shares = model.shares(average + model.bias if folded else model.logits(average))
        known = letters & (counts > 0)
        best = np.where(known, shares.argmax(axis=1), len(model.languages))
        return list(names[best]), np.where(known, shares.max(axis=1), 0.0)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                names, score = predict(part.column("text").to_pylist())
                columns = [part.column("row"), pa.array(names, pa.string()), pa.array(score), pa.array(score >= model.least_score)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "lang_pred", "score", "accepted"])

    small_batches(docs.sparkSession)
    texts = docs.select(F.struct(*keep).alias("row"), F.lower(F.col("text").cast("string")).alias("text"))
    row = texts.schema["row"].dataType.simpleString()
    return texts.mapInArrow(task, f"row {row}, lang_pred string, score double, accepted boolean")


def op11_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the labelled ones that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predictions(docs, learn(docs), "doc_id")
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
