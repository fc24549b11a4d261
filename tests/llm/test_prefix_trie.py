"""The prefix trie against a plain one, and its parts."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from packedts.llm.prefix_trie import _digests, numbered, prefix_trie, prefixes, rebuilt, turn_rows, two_fattest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, depth string, h1 string, part string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(convs):
    """The contract's rows for conversations {conv_id: [(role, text), ...]}."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(WORD.findall(node[-1][1])) if node else 0
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[c] for c in children[node])
    return sorted(
        (
            min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(c for c in members[n] if len(convs[c]) == len(n)))).encode()).hexdigest(),
        )
        for n in members
    )


def in_order(rows):
    """{conv_id: [(role, text), ...]} in the order of turn and of the turn's MD5."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            code = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[conv].append(((turn is not None, turn), code, role, text))
    return {c: [(role, text) for *_, role, text in sorted(turns)] for c, turns in convs.items()}


def plain_rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - int(np.fmod(c, 20)), [])[:h] + turns[h:]
    return out


def table(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "d", "h", "p") for r in rows], SCHEMA).repartition(parts)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: (r[0], r[1]))


def trie_of(spark, rows, parts=4):
    turns = numbered(turn_rows(table(spark, rows, parts)))
    return prefix_trie(turns, turns.groupBy("conv_id").agg(F.max("place").alias("length")))


def spelled(conv, letters):
    """A conversation with one turn per letter."""
    return [(conv, k, "user", f"{c} {c}") for k, c in enumerate(letters)]


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    rows = spark.createDataFrame(pairs, "a long, b long").withColumn("f", two_fattest(F.col("a"), F.col("b"))).collect()
    for r in rows:
        assert r.f == max(range(r.a + 1, r.b + 1), key=lambda n: n & -n)


@pytest.mark.parametrize(
    "strings",
    [
        ["a"],
        ["abc", "abc", "abc"],
        ["abcdefgh", "abcdefgx", "abcx", "abc", "a", "b", "bcd", "abcdefghijklmnopq"],
        ["a" * n for n in range(1, 24)],  # every one a prefix of the next
        ["a" * n + "b" for n in range(12)] + ["a" * 12],
        ["".join(s) for s in __import__("itertools").product("ab", repeat=4)],
    ],
)
def test_tries(spark, strings):
    rows = [r for c, s in enumerate(strings) for r in spelled(c, s)]
    assert found(trie_of(spark, rows)) == sorted(plain_trie(in_order(rows)), key=lambda r: r[:2])


def test_random_tries(spark):
    rng = np.random.default_rng(11)
    rows = []
    for c in range(150):
        rows += spelled(c, "".join(rng.choice(list("ab"), rng.integers(1, 14), p=[0.8, 0.2])))
    assert found(trie_of(spark, rows)) == sorted(plain_trie(in_order(rows)), key=lambda r: r[:2])


def test_no_hash_tables_pass_the_driver(spark):
    trie = trie_of(spark, [row for conv, letters in enumerate(["ab", "abc", "b", "abd"]) for row in spelled(conv, letters)])
    assert len(trie.collect()) == 6
    plan = trie._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def odd_rows():
    rng = np.random.default_rng(2)
    words = ["x", "y z", "", None, "é ü", "\t\n"]
    rows = [(int(c), int(t), ["user", "assistant", None][t % 3], words[rng.integers(0, 6)]) for c in range(-45, 90) for t in range(rng.integers(1, 7))]
    rows += [(100, None, "user", "null turn"), (100, 0, "user", "first"), (100, None, None, None)]
    rows += [(101, 5, "a", "tie"), (101, 5, "b", "tie"), (101, 5, "a", "tie")]  # equal turns, and a repeated row
    rows += [(None, 0, "user", "no conversation")]
    rows += [(c, 0, "user", "alone, base absent") for c in range(201, 212)]
    rows += [(160, t, "user", f"long {t // 3}") for t in range(700)] + [(165, t, "user", f"long {t // 3}") for t in range(650)]
    rows += [(180, 0, "user", "word " * 30_000)]
    return rows


@pytest.mark.parametrize("parts", [1, 7])
def test_rebuilt_conversations(spark, parts):
    rows = odd_rows()
    expected = plain_rebuilt(in_order(rows))
    assert any(not turns for turns in expected.values())
    turns = numbered(turn_rows(table(spark, rows, parts)))
    assert found(prefix_trie(*rebuilt(turns))) == sorted(plain_trie(expected), key=lambda r: r[:2])


def test_conversations_that_span_partitions(spark):
    """Places and keys are carried on between range partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        rows = [(1, t, "user", f"t {t % 5}") for t in range(500)] + [(2, t, "user", f"t {t % 5}") for t in range(300)] + [(3, 0, "user", "t 0")]
        turns = numbered(turn_rows(table(spark, rows, 6)))
        places = sorted((r.conv_id, r.place) for r in turns.collect())
        assert places == [(1, p) for p in range(1, 501)] + [(2, p) for p in range(1, 301)] + [(3, 1)]
        paths = {(r.conv_id, r.depth): r for r in prefixes(turns).collect()}
        assert all(paths[1, d][2:] == paths[2, d][2:] for d in range(1, 301))
        assert paths[1, 500].all_words == 1000 and len({(r.h1, r.h2) for r in paths.values()}) == 500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_digests_of_large_groups(spark):
    ids = spark.range(30_000).select((F.col("id") % 2).alias("h1"), F.lit(0).cast("long").alias("h2"), F.col("id").alias("conv_id"))
    for r in _digests(ids).collect():
        assert r.ends_sha256 == hashlib.sha256(",".join(map(str, range(r.h1, 30_000, 2))).encode()).hexdigest()


def test_no_conversations(spark):
    assert found(trie_of(spark, [])) == []
    assert found(trie_of(spark, [(None, 0, "user", "x")])) == []
