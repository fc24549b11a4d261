"""The stages of the corpus pipeline, each against a plain version, and the whole run on a small table."""

import re

import numpy as np
import pytest

import corpus_pipeline
from packedts.llm.mixing import mix_sources
from packedts.llm.surrogates import find_entities
from packedts.llm.toxicity import learn, scores

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score string, _key string"
STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = corpus_pipeline.COLUMNS


def table(spark, rows):
    full = [(i, t, "en", s, len(t) if t is not None else None, "r", "s", "k") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def some_rows():
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 7))) for _ in range(300)]
    texts = [" ".join(rng.choice(words, rng.integers(20, 90))) for _ in range(40)]
    rows = [(k, t, f"s{k % 3}") for k, t in enumerate(texts)]
    rows += [(100 + k, texts[k], "s0") for k in range(5)]  # exact copies
    rows += [(110 + k, texts[k + 5] + " more", "s1") for k in range(5)]  # near copies
    rows += [(2, texts[0], "s0"), (2, texts[0], "s0"), (2, "a text of its own that shares the id of another one", "s0")]
    rows += [(None, texts[1], "s2"), (None, "without an id but with words of its own", "s2"), (None, None, None)]
    rows += [(200, None, "s0"), (201, "", "s0"), (202, " \n", None), (203, "one", "s1"), (204, "line one\nline two\n" * 400, "s1")]
    return rows


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """A folder with documents and labels."""
    path = tmp_path_factory.mktemp("tables")
    docs = table(spark, some_rows())
    docs.write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(k, 1, int(k < 0)) for k in range(20)], "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def plain(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def shingles(text):
    words = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in WORD.findall(text or "")]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def plain_near_dedup(rows):
    """(doc_id, text) of the rows that stay, by comparing all pairs."""
    docs = sorted({(i is None, i if i is not None else 0, t is not None, t or "") for i, t, _ in rows})
    sets = [shingles(t) for *_, t in docs]
    root = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return [(None if no_id else i, t if some else None) for k, (no_id, i, some, t) in enumerate(docs) if root[k] == k]


def key(pair):
    return (pair[0] is None, pair[0] or 0, pair[1] or "")


def test_near_dedup(spark):
    rows = some_rows()
    found = STAGES["near_dedup"](spark, table(spark, rows), "")
    assert found.columns == COLUMNS
    got = sorted(((r.doc_id, r.text) for r in found.collect()), key=key)
    assert got == sorted(plain_near_dedup(rows), key=key)
    assert (2, "a text of its own that shares the id of another one") in got and (2, rows[2][1]) in got


def test_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    kept = STAGES["toxicity"](spark, docs, sf)
    scored = scores(docs, learn(docs, labels), "doc_id").collect()
    expected = {r.row.doc_id for r in scored if r.score < 0.5}
    assert {r.doc_id for r in kept.collect()} == expected and len(expected) < docs.count()
    assert kept.columns == COLUMNS
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    assert len(expected & toxic) < len(toxic) / 3


def test_nothing_is_toxic_without_toxic_labels(spark, sf_dir):
    docs = table(spark, some_rows())
    assert plain(STAGES["toxicity"](spark, docs, sf_dir)) == plain(docs)


def test_personal_data(spark):
    rows = [(1, "Write to ann.lee@mail.example.org or +49 30 1234567.", "s0"), (2, "Nothing here.", "s0"), (3, None, "s0"), (4, "", None)]
    found = {r.doc_id: r for r in STAGES["personal_data"](spark, table(spark, rows), "").collect()}
    assert "ann.lee" not in found[1].text and "1234567" not in found[1].text
    assert [e[2] for e in find_entities(found[1].text)] == ["email", "phone"]
    assert (found[2].text, found[3].text, found[4].text) == ("Nothing here.", None, "")
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in found.values())


def test_mix(spark):
    rows = some_rows()
    docs = table(spark, rows)
    out = STAGES["mix"](spark, docs, "").collect()
    taken = sum(r.taken for r in mix_sources(docs).collect())
    assert sum(len(WORD.findall(r.text)) for r in out) == taken
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, []).append(t or "")
    for r in out:
        assert any(r.text in t for t in texts[r.doc_id]), r.text  # parts keep their white space
        assert r.n_chars == len(r.text)


def test_packing_and_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert out
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    # the stages by hand, one after the other
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    pieces = STAGES["packing"](spark, docs, sf_dir).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.start, r.length) for r in pieces) == sorted(
        (r.doc_id is None, r.doc_id or 0, r.start, r.length) for r in out
    )


def test_empty_table(spark, tmp_path):
    table(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
