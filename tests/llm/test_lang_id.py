"""Language identification: subwords against a plain reader, held-out accuracy, awkward texts."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from packedts.llm.lang_id import (
    FACTORS,
    FINISH,
    STEP,
    UNKNOWN,
    Model,
    Training,
    averages,
    characters,
    learn,
    op11_lang_id,
    pieces_of,
    predictions,
    subwords,
)

SF_DIR = "/root/testdata/sf0.01"
WORDS = {
    "aa": "banda konda lumba samba timba rumba gonda manda".split(),
    "bb": "strik kraft schrift wicht pfund zwist sprung knicks".split(),
}


def plain_buckets(text, buckets):
    """Every run of 2 to 4 characters of a word and the blanks around it, one at a time."""
    inside = characters()[1]
    codes = [ord(c) if inside[ord(c)] else 0 for c in f"\n{text}\n"]
    found = []
    for n in (2, 3, 4):
        for i in range(len(codes) - n + 1):
            gram = codes[i : i + n]
            if not all(gram[1:-1]) or not any(gram):
                continue
            h = sum(c * int(f) for c, f in zip(gram, FACTORS)) + n
            h = h * int(FINISH) % 2**64
            h = (h ^ (h >> 32)) * int(FINISH) % 2**64
            found.append((h >> 48) % buckets)
    return sorted(found)


@pytest.mark.parametrize("text", ["", "a", "ab", "one two", " x  y ", "naïve café 12 été", "हिन्दी पाठ", "中文 文本", "a1b2", "😀 ok", "\n\nq\n"])
def test_subwords(text):
    found = [subwords(points, begins, 4096)[0] for points, begins, _ in pieces_of([text])]
    assert sorted(np.concatenate(found).tolist()) == plain_buckets(text, 4096)


def test_long_texts_are_read_whole_and_once():
    rng = np.random.default_rng(3)
    long = " ".join(rng.choice(["abcdefghij" * 4, "k", "été"], 60_000))
    assert len(long) > 5 * STEP
    texts = ["ab", long, None, "", "cd ef"]
    runs = [(subwords(points, begins, 1 << 16), of) for points, begins, of in pieces_of(texts)]
    assert len(runs) > 4
    counts = np.zeros(len(texts), int)
    for (_, piece), of in runs:
        np.add.at(counts, of[piece], 1)
    assert counts.tolist() == [len(plain_buckets(t or "", 1 << 16)) for t in texts]
    table = rng.normal(size=(1 << 16, 3))
    average, n, letters = averages(texts, table)
    assert n.tolist() == counts.tolist() and letters.tolist() == [True, True, False, False, True]
    assert np.allclose(average[1], table[plain_buckets(long, 1 << 16)].mean(axis=0))
    assert np.allclose(average[0], table[plain_buckets("ab", 1 << 16)].mean(axis=0))


SCHEMA = "doc_id long, text string, lang string, row string, score string, lang_pred string"


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(240):
        lang = "aa" if k % 3 else "bb"
        rows.append((k, " ".join(rng.choice(WORDS[lang], rng.integers(1, 40))), lang))
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 !?", "aa"), (1003, "banda", None), (None, "strik", "bb"), (3, "samba timba", "aa")]
    rows += [(1004, "banda " * 60_000, "aa"), (1005, "BANDA KONDA", "aa"), (5, rows[5][1], rows[5][2])]
    return spark.createDataFrame([(*r, "r", "s", "l") for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def model(docs):
    return learn(docs)


def test_predictions(docs, model):
    assert model.languages == ("aa", "bb")
    found = predictions(docs, model, "doc_id", "text", "lang").select("row.*", "lang_pred", "score", "accepted").collect()
    assert len(found) == docs.count()
    for r in found:
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == UNKNOWN) == (not has_letter)
        assert 0 <= r.score <= 1 and (has_letter or (r.score == 0 and not r.accepted))
        assert r.accepted == (r.score >= model.least_score) or not has_letter
    told = [r for r in found if r.lang and r.lang_pred != UNKNOWN]
    assert sum(r.lang == r.lang_pred for r in told) == len(told)


def test_folded_softmax_is_the_same(docs, model):
    """Few languages: the softmax is applied to the embeddings first."""
    wide = Model(model.languages, np.tile(model.embeddings, 1)[:, :1], model.weights[:1], model.bias, model.temperature, model.least_score)
    texts = [r.text for r in docs.select("text").limit(50).collect()]
    average, _, _ = averages([t and t.lower() for t in texts], wide.embeddings)
    one_by_one = wide.shares(wide.logits(average)).argmax(axis=1)
    folded, _, _ = averages([t and t.lower() for t in texts], wide.embeddings @ wide.weights)
    assert (wide.shares(folded + wide.bias).argmax(axis=1) == one_by_one).all()


def test_held_out_rows_are_not_learned_from(docs, model):
    """Wrong labels on held-out rows change nothing."""
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    again = learn(docs.withColumn("lang", F.when(out, "zz").otherwise(F.col("lang"))))
    assert again.languages == model.languages and (again.weights == model.weights).all()


def test_strange_texts_are_rejected(spark, model):
    """Scores of words of no known language stay below those of known ones."""
    rows = [(1, "qqq xwx yyq"), (2, "banda konda lumba samba")]
    found = {r.row.doc_id: r for r in predictions(spark.createDataFrame(rows, "doc_id long, text string"), model, "doc_id").collect()}
    assert found[1].score < found[2].score and found[2].accepted


def test_samples_are_even_and_bounded(spark):
    rows = [(k, f"text {k}", "much" if k % 50 else "little") for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    from packedts.llm.lang_id import _sample

    taken = {r.lang: r["count"] for r in _sample(docs, Training(sample=100)).groupBy("lang").count().collect()}
    assert taken["much"] == 50 and 40 <= taken["little"] <= 50


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = learn(empty)
    assert model.languages == () and predictions(empty, model, "doc_id").count() == 0
    rows = predictions(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), model, "doc_id").collect()
    assert [(r.lang_pred, r.score, r.accepted) for r in rows] == [(UNKNOWN, 0.0, False)]


def test_held_out_accuracy(spark):
    found = op11_lang_id(spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    out = [r for r in found if r.held_out]
    assert len(out) > 100 and sum(r.lang == r.lang_pred for r in out) >= 0.98 * len(out)
