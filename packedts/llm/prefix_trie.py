"""Prefix trie of conversations, built as a z-fast trie in tables.

A conversation is its sequence of turns. The key of a sequence is the exclusive or of a 128-bit hash of
every (place, role, text) in it, so the keys of all prefixes are running totals, and equal keys
stand for equal prefixes. Equal conversations are one string of the trie, under their least id.

The trie is kept compacted: a node is a depth where strings part or end, with the edge that leads
to it, from its parent's depth to its own. An edge belongs to a string that runs along it, and is looked up by
its handle, the key at the two-fattest depth on it (the multiple of the highest power of two).
Strings come in by batches. The exit node of each is the deepest one whose handle it meets, the one at which a fat
binary search ends; as a join answers all lookups at once, all keys of a string are looked up together, not
step by step. The keys along the exit edge give the depth of the exit. Of the strings that leave at the
same place with the same turn, one, drawn by hash, goes in; edges are split where strings leave them, and the
others are located again in the next batch. As the one is drawn, a batch halves what is left of
a crowded branch on average, so the number of batches grows with the logarithm of the strings.
At last edges are expanded to one row per depth, and figures of subtrees are added up by doubling:
after step k every node holds what lies within 2**k below it.

Scale: all state lies in tables, a row per turn or node, joined by key; nothing is gathered by
conversation, node or prefix. Places and running totals are counted inside range partitions first,
so a conversation with a third of all turns spans many tasks; what crosses between
partitions is a row for each partition. Lookups have one row per key on their right side; their crowded left sides
are salted or split by adaptive execution. Sums are partly aggregated before each shuffle. Only the
digest of the ids that end at a node passes one task per node, as SHA-256 is sequential: ids
alone, in Spark's sort order, as a stream.

Defined results: null roles and texts are empty; rows without conv_id are no conversation's; turns
of equal number stand in the order of the MD5 of octet_length(role) || ':' || role || text, repeated
rows are turns of their own; an empty table has no nodes; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packedts.llm.components import stored

SALTS = 8
NOTHING = hashlib.sha256(b"").hexdigest()
# Rebuilding: conversations borrow their first turns from the first one of their block.
BLOCK, HEADS = 20, 4
STEPS = np.array([0x9E3779B97F4A7C15, 0xD1B54A32D192ED03], np.uint64)


# --- turns and the keys of their prefixes ---------------------------------------------------


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, code (the hash of role and text) and words of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    code = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        code.alias("code"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )


def _in_order(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows in ranges of the keys, sorted; equal keys may be spread over several tasks."""
    spread = rows.withColumn("_spread", F.spark_partition_id())
    return spread.repartitionByRange(*keys, "_spread").sortWithinPartitions(*keys).drop("_spread")


def _runs(conv: np.ndarray) -> np.ndarray:
    """The row at which each row's conversation begins in this batch."""
    first = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
    return np.repeat(first, np.diff(np.append(first, len(conv))))


def _carried(rows: DataFrame, place: str, totals: list[str], plus) -> DataFrame:
    """rows (part, conv_id, ...) with the totals of a conversation carried on from partition to partition.

    In a partition they count from its own first row. Only the first and the last conversation of a
    partition can lie in others too, so two rows a partition tell all that is carried.
    """
    spark = rows.sparkSession
    bounds = rows.groupBy("part").agg(F.min("conv_id").alias("lo"), F.max("conv_id").alias("hi"))
    last = (
        rows.join(F.broadcast(bounds), "part")
        .where("conv_id = lo OR conv_id = hi")
        .groupBy("conv_id", "part")
        .agg(F.max(F.struct(place, *totals)).alias("last"))
        .collect()
    )
    before, held, of = [], None, None
    for r in sorted(last, key=lambda r: (r.conv_id, r.part)):
        if r.conv_id != of:
            of, held = r.conv_id, [0] * len(totals)
        elif any(held):
            before.append((r.part, r.conv_id, *held))
        held = [f(h, r.last[t]) for f, h, t in zip(plus, held, totals)]
    if not before:
        return rows.drop("part")
    names = [f"_{t}" for t in totals]
    carried = spark.createDataFrame(before, ", ".join(["part int, conv_id long", *(f"{n} long" for n in names)]))
    joined = rows.join(F.broadcast(carried), ["part", "conv_id"], "left")
    for name, total, f in zip(names, totals, plus):
        joined = joined.withColumn(total, f(F.col(total), F.coalesce(F.col(name), F.lit(0).cast("long"))))
    return joined.drop("part", *names)


def _merged(table: DataFrame) -> DataFrame:
    """A table joined by sorting both sides, however small it is: the many hash tables of small ones would pass the driver."""
    return table.hint("merge")


def _add(a, b):
    return a + b


def _xor(a, b):
    return a.bitwiseXOR(b) if isinstance(a, Column) else a ^ b


def numbered(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 1), code and words of every turn, in the order of turn and code."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        of, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv_id").to_numpy()
            place = np.arange(1, len(conv) + 1) - _runs(conv)
            if of == conv[0]:
                place[conv == conv[0]] += seen
            of, seen = conv[-1], place[-1]
            columns = [pa.array(np.full(len(conv), part, np.int32)), batch.column("conv_id"), pa.array(place), batch.column("code"), batch.column("words")]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "conv_id", "place", "code", "words"])

    # stored first, as sampling the ranges reads the rows once more
    ordered = _in_order(stored(rows, "turn-rows"), "conv_id", "turn", "code")
    placed = stored(ordered.mapInArrow(task, "part int, conv_id long, place long, code binary, words long"), "turns")
    return _carried(placed, "place", ["place"], [_add])


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, h1, h2 (the key of the first depth turns), words and all_words of every prefix of (conv_id, place, code, words)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        of, held = None, [np.uint64(0), np.uint64(0), np.int64(0)]
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, place = batch.column("conv_id").to_numpy(), batch.column("place").to_numpy()
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), "<u8").reshape(-1, 2)
            first = _runs(conv)
            begun = conv == conv[0] if of == conv[0] else np.zeros(len(conv), bool)
            lanes = []
            for lane in (0, 1):
                h = code[:, lane] + place.astype(np.uint64) * STEPS[lane]
                for factor in (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)):
                    h = (h ^ (h >> np.uint64(30))) * factor
                h ^= h >> np.uint64(31)
                run = np.bitwise_xor.accumulate(h)
                run ^= np.append(np.uint64(0), run)[first]
                run[begun] ^= held[lane]
                lanes.append(run)
            words = batch.column("words").to_numpy()
            total = np.cumsum(words)
            total = total - np.append(0, total)[first]
            total[begun] += held[2]
            of, held = conv[-1], [lanes[0][-1], lanes[1][-1], total[-1]]
            columns = [np.full(len(conv), part, np.int32), conv, place, lanes[0].view(np.int64), lanes[1].view(np.int64), words, total]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "conv_id", "depth", "h1", "h2", "words", "all_words"])

    keyed = _in_order(turns, "conv_id", "place").mapInArrow(
        task, "part int, conv_id long, depth long, h1 long, h2 long, words long, all_words long"
    )
    return _carried(stored(keyed, "prefixes"), "depth", ["h1", "h2", "all_words"], [_xor, _xor, _add])


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of their block's first one: turns (conv_id, place, code, words), and conv_id, length of all.

    The first h places of conversation c, h = crc32(c) % HEADS, are those of conversation c - c % BLOCK (all it
    has, if fewer); c's own turns from the place after its own first h follow.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    lengths = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    firsts = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("base_length"))
    convs = (
        lengths.withColumn("base", F.col("conv_id") - F.col("conv_id") % BLOCK)
        .withColumn("h", h)
        .join(_merged(firsts), "base", "left")
        .withColumn("borrowed", F.least("h", F.coalesce("base_length", F.lit(0).cast("long"))))
        .withColumn("length", F.col("borrowed") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    )
    convs = stored(convs.select("conv_id", "base", "h", "borrowed", "length"), "conversations")
    heads = turns.where(F.col("place") < HEADS).withColumnRenamed("conv_id", "base")
    borrowed = convs.where("borrowed > 0").join(_merged(heads), "base").where("place <= borrowed").select("conv_id", "place", "code", "words")
    own = turns.withColumn("h", h).where("place > h")
    # few lack turns to borrow; their own ones move up
    short = convs.where("borrowed < h").select("conv_id", (F.col("h") - F.col("borrowed")).alias("missing"))
    own = _looked_up(own, short, ["conv_id"], "place").withColumn("place", F.col("place") - F.coalesce("missing", F.lit(0).cast("long")))
    return borrowed.unionByName(own.select("conv_id", "place", "code", "words")), convs.select("conv_id", "length")


# --- lookups -------------------------------------------------------------------------------


def _looked_up(left: DataFrame, right: DataFrame, on: list[str], spread: str, how: str = "left") -> DataFrame:
    """left joined to right, which has one row per key; a key that much of left has is dealt to SALTS tasks by spread."""
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS))
    salted = right.withColumn("_salt", F.explode(F.array(*(F.lit(s).cast("long") for s in range(SALTS)))))
    return left.withColumn("_salt", salt).join(_merged(salted), [*on, "_salt"], how).drop("_salt")


def two_fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] that the highest power of two divides."""
    low_bits = F.length(F.bin(a.bitwiseXOR(b))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", b, low_bits), low_bits)


def _at(rows: DataFrame, paths: DataFrame, depth: Column, name: str) -> DataFrame:
    """rows (string, ...) with the key at a depth of each one's string, as name1 and name2; null beyond its end and at 0."""
    keys = paths.select(F.col("conv_id").alias("string"), F.col("depth").alias("_d"), F.col("h1").alias(f"{name}1"), F.col("h2").alias(f"{name}2"))
    return rows.withColumn("_d", depth).join(_merged(keys), ["string", "_d"], "left").drop("_d")


# --- the compacted trie ----------------------------------------------------------------------

# A node: its edge belongs to string y, which went in at depth s with key (s1, s2), and runs from pe to e; the
# key at pe is (p1, p2), the one at e (x1, x2).
NODE = ["y", "s", "s1", "s2", "pe", "e", "p1", "p2", "x1", "x2"]
POINT = ["y", "s", "s1", "s2", "e", "x1", "x2"]


def _nodes(points: DataFrame) -> DataFrame:
    """The nodes of the depths at which each string's own stretch ends, parts or is left."""
    along = Window.partitionBy("y").orderBy("e")
    return (
        points.withColumn("pe", F.coalesce(F.lag("e").over(along), F.col("s")))
        .withColumn("p1", F.coalesce(F.lag("x1").over(along), F.col("s1")))
        .withColumn("p2", F.coalesce(F.lag("x2").over(along), F.col("s2")))
        .select(*NODE)
    )


def _sites(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Where nodes are found: k1, k2 is the key at the handle's depth (kind handle) and at the edge's first turn (kind name)."""
    sites = F.array(
        F.struct(F.lit("name").alias("kind"), (F.col("pe") + 1).alias("depth")),
        F.struct(F.lit("handle").alias("kind"), two_fattest(F.col("pe"), F.col("e")).alias("depth")),
    )
    keys = paths.select(F.col("conv_id").alias("y"), "depth", F.col("h1").alias("k1"), F.col("h2").alias("k2"))
    return nodes.select(*NODE, F.inline(sites)).join(_merged(keys), ["y", "depth"]).drop("depth")


def _located(strings: DataFrame, paths: DataFrame, sites: DataFrame | None) -> DataFrame:
    """strings (string, length, h1, h2) with the deepest node whose handle each one meets.

    That node is where a fat binary search ends. The search would take a join for each of its steps; here all keys of
    a string are looked up in one. Without a node the root is meant: e = 0.
    """
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    if sites is None:
        return strings.select("*", *((zero if c == "e" else none).alias(c) for c in NODE))
    handles = sites.where("kind = 'handle'").select("k1", "k2", *NODE)
    keys = paths.select(F.col("conv_id").alias("string"), "depth", F.col("h1").alias("k1"), F.col("h2").alias("k2"))
    met = _looked_up(keys, handles, ["k1", "k2"], "string", "inner")
    deepest = met.groupBy("string").agg(F.max(F.struct("depth", *NODE)).alias("node"))
    found = strings.join(_merged(deepest), "string", "left")
    return found.select(*strings.columns, *((F.coalesce("node.e", zero) if c == "e" else F.col(f"node.{c}")).alias(c) for c in NODE))


def _exits(located: DataFrame, paths: DataFrame, all_paths: DataFrame, sites: DataFrame | None) -> DataFrame:
    """Where each string leaves the trie: at depth k, of the edge of a node if y is not null.

    Also the key at k, (c1, c2), and the one a turn on, (t1, t2), null for strings that end at k.
    """
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    found = _at(_at(located, paths, F.col("e"), "c"), paths, F.col("e") + 1, "t")
    through = (F.col("e") == 0) | ((F.col("c1") == F.col("x1")) & (F.col("c2") == F.col("x2")))
    found = stored(found.withColumn("through", F.coalesce(through, F.lit(False))), "located")
    # strings that run through the node and on: into one of its edges, or off it
    on = found.where("through AND length > e").select("string", "length", "h1", "h2", F.col("e").alias("k"), "c1", "c2", "t1", "t2")
    ended = found.where("through AND length = e").select(*on.columns[:4], F.col("e").alias("k"), *(none.alias(c) for c in ("c1", "c2", "t1", "t2", *NODE)))
    if sites is None:
        return ended.unionByName(on.select("*", *(none.alias(c) for c in NODE)))
    names = sites.where("kind = 'name'").select(F.col("k1").alias("t1"), F.col("k2").alias("t2"), *NODE)
    # stored, as three parts of what follows read it
    on = stored(_looked_up(on, names, ["t1", "t2"], "string"), "on")
    off = on.where("y IS NULL")
    inside = on.where("y IS NOT NULL").select("string", "length", "h1", "h2", *NODE)
    inside = inside.unionByName(found.where("NOT through").select("string", "length", "h1", "h2", *NODE))
    # as many turns of the edge as keys agree: keys agree up to where the string leaves, and no further
    mine = paths.select(F.col("conv_id").alias("string"), "depth", F.col("h1").alias("k1"), F.col("h2").alias("k2"))
    its = all_paths.select(F.col("conv_id").alias("y"), "depth", F.col("h1").alias("k1"), F.col("h2").alias("k2"))
    agreed = (
        inside.select("string", "y", "pe", "e").join(_merged(mine), "string").where("depth > pe AND depth <= e")
        .join(_merged(its), ["y", "depth", "k1", "k2"], "left_semi")
        .groupBy("string").agg(F.count(F.lit(1)).alias("agreed"))
    )
    inside = inside.join(_merged(agreed), "string").withColumn("k", F.col("pe") + F.col("agreed")).drop("agreed")
    inside = _at(_at(inside, paths, F.col("k"), "c"), paths, F.col("k") + 1, "t")
    return ended.unionByName(off).unionByName(inside.select(*ended.columns))


def build(classes: DataFrame, all_paths: DataFrame) -> DataFrame:
    """The nodes of the compacted trie of strings (string, length, h1, h2), without the root."""
    spark = classes.sparkSession
    zero = F.lit(0).cast("long")
    points = spark.createDataFrame([], ", ".join(f"{c} long" for c in POINT))
    open_, sites, batch = classes.where("length > 0"), None, 0
    while True:
        open_ = stored(open_.select("string", "length", "h1", "h2"), "open")
        if open_.isEmpty():
            return _nodes(points)
        paths = stored(all_paths.join(_merged(open_.select(F.col("string").alias("conv_id"))), "conv_id", "left_semi"), "paths")
        if batch == 0:
            all_paths = paths
        exits = stored(_exits(_located(open_, paths, sites), paths, all_paths, sites), "exits")
        leaving = exits.where("t1 IS NOT NULL")
        first = leaving.groupBy("t1", "t2").agg(F.min(F.struct(F.xxhash64("string", F.lit(batch)).alias("draw"), "string")).alias("first"))
        first = leaving.join(_merged(first.select(F.col("first.string").alias("string"))), "string", "left_semi")
        leaves = first.select(
            F.col("string").alias("y"), F.col("k").alias("s"), F.coalesce("c1", zero).alias("s1"), F.coalesce("c2", zero).alias("s2"),
            F.col("length").alias("e"), F.col("h1").alias("x1"), F.col("h2").alias("x2"),
        )
        splits = exits.where("y IS NOT NULL AND k < e").select("y", "s", "s1", "s2", F.col("k").alias("e"), F.col("c1").alias("x1"), F.col("c2").alias("x2"))
        points = stored(points.unionByName(leaves).unionByName(splits.distinct()), "points")
        sites = stored(_sites(_nodes(points), all_paths), "sites")
        open_ = leaving.join(_merged(leaves.select(F.col("y").alias("string"))), "string", "left_anti")
        batch += 1


# --- figures of subtrees, and expansion ----------------------------------------------------------


def _subtrees(nodes: DataFrame, sums: list[str], least: list[str]) -> DataFrame:
    """nodes (x1, x2, p1, p2, ...) with sums and minima of the named columns over each node's subtree.

    The root has a null parent. In step k every node passes its figures, those of the 2**k levels from it down, to
    the node 2**k above, and learns which one is twice as far.
    """
    figures = [*sums, *least]
    state = stored(nodes.select("x1", "x2", F.col("p1").alias("j1"), F.col("p2").alias("j2"), *figures), "subtrees")
    while state.where("j1 IS NOT NULL").limit(1).count():
        passed = state.where("j1 IS NOT NULL").groupBy(F.col("j1").alias("x1"), F.col("j2").alias("x2"))
        passed = passed.agg(*(F.sum(c).alias(f"_{c}") for c in sums), *(F.min(c).alias(f"_{c}") for c in least))
        higher = state.where("j1 IS NOT NULL").select(F.col("x1").alias("j1"), F.col("x2").alias("j2"), F.col("j1").alias("_j1"), F.col("j2").alias("_j2"))
        joined = _looked_up(state.join(_merged(passed), ["x1", "x2"], "left"), higher, ["j1", "j2"], "x1")
        state = stored(
            joined.select(
                "x1", "x2", F.col("_j1").alias("j1"), F.col("_j2").alias("j2"),
                *((F.col(c) + F.coalesce(f"_{c}", F.lit(0).cast("long"))).alias(c) for c in sums),
                *(F.least(c, f"_{c}").alias(c) for c in least),
            ),
            "subtrees",
        )
    return nodes.drop(*figures).join(_merged(state.drop("j1", "j2")), ["x1", "x2"])


def _digests(members: DataFrame) -> DataFrame:
    """h1, h2 and ends_sha256: the digest of the ids of (conv_id, h1, h2) with one key, ascending and comma-joined."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("ends_sha256", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            h1, h2, ids = (batch.column(c).to_numpy() for c in ("h1", "h2", "conv_id"))
            done = []
            starts = np.flatnonzero(np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))) if len(ids) else []
            for lo, hi in zip(starts, np.append(starts[1:], len(ids))):
                if key == (h1[lo], h2[lo]):
                    digest.update(b",")
                else:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (h1[lo], h2[lo]), hashlib.sha256()
                digest.update(",".join(map(str, ids[lo:hi].tolist())).encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*key, digest.hexdigest()), schema)], schema=schema)

    ids = members.select("h1", "h2", "conv_id").repartition("h1", "h2").sortWithinPartitions("h1", "h2", "conv_id")
    return ids.mapInArrow(task, "h1 long, h2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations: turns (conv_id, place, code, words), and all of them (conv_id, length).

    conv_id is the least id with the prefix, parent_conv_id that of the prefix a turn shorter; n_convs conversations begin
    with it; its subtree has n_leaves prefixes that none goes on from; saved_tokens counts the words of the subtree's turns
    that need not be stored again; ends_sha256 digests the ids that are just this prefix.
    """
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    paths = prefixes(turns)
    ends = convs.join(_merged(paths.select("conv_id", F.col("depth").alias("length"), "h1", "h2")), ["conv_id", "length"], "left")
    ends = stored(ends.select("conv_id", "length", F.coalesce("h1", zero).alias("h1"), F.coalesce("h2", zero).alias("h2")), "ends")
    classes = ends.groupBy("length", "h1", "h2").agg(F.min("conv_id").alias("string"), F.count(F.lit(1)).alias("n_convs"))
    classes = stored(classes, "classes")
    nodes = build(classes, paths).select("y", "pe", "e", "p1", "p2", "x1", "x2")
    root = classes.groupBy().agg(F.min("string").alias("y")).where("y IS NOT NULL")
    root = root.select("y", F.lit(-1).cast("long").alias("pe"), zero.alias("e"), none.alias("p1"), none.alias("p2"), zero.alias("x1"), zero.alias("x2"))
    nodes = nodes.unionByName(root)
    children = nodes.where("p1 IS NOT NULL").groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count(F.lit(1)).alias("n_children"))
    own = classes.select(F.col("h1").alias("x1"), F.col("h2").alias("x2"), F.col("string").alias("conv_id"), "n_convs")
    nodes = nodes.join(_merged(children), ["x1", "x2"], "left").join(_merged(own), ["x1", "x2"], "left")
    nodes = nodes.fillna(0, ["n_children", "n_convs"]).withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
    nodes = _subtrees(stored(nodes, "nodes"), ["n_convs", "n_leaves"], ["conv_id"])
    # words from the root to either end of each edge
    words = paths.select(F.col("conv_id").alias("y"), F.col("depth").alias("pe"), F.col("all_words").alias("words_before"))
    nodes = nodes.join(_merged(words), ["y", "pe"], "left").join(_merged(words.toDF("y", "e", "words_to")), ["y", "e"], "left").fillna(0, ["words_before", "words_to"])
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * (F.col("words_to") - F.col("words_before"))).withColumn("own_saved", F.col("saved"))
    nodes = _subtrees(stored(nodes, "nodes"), ["saved"], [])
    parents = nodes.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("above"))
    digests = _digests(ends).withColumnsRenamed({"h1": "x1", "h2": "x2"})
    nodes = _looked_up(nodes, parents, ["p1", "p2"], "x1").join(_merged(digests), ["x1", "x2"], "left")
    rows = nodes.withColumn("depth", F.explode(F.sequence(F.col("pe") + 1, F.col("e"))))
    rows = rows.join(_merged(paths.select(F.col("conv_id").alias("y"), "depth", "words", "all_words")), ["y", "depth"], "left").fillna(0, ["words", "all_words"])
    last = F.col("depth") == F.col("e")
    return rows.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > F.col("pe") + 1, F.col("conv_id")).otherwise(F.col("above")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        # the rest of the edge, this turn included, and all below it
        (F.col("saved") - F.col("own_saved") + (F.col("n_convs") - 1) * (F.col("words_to") - F.col("all_words") + F.col("words"))).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(NOTHING))).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each with its borrowed first turns."""
    turns = numbered(turn_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return prefix_trie(*rebuilt(turns))


# crc32 has no function here: eight shifts for each byte of the decimal id
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(CAST({c} AS VARCHAR)) + 1),
    lambda i: CAST(ascii(substr(CAST({c} AS VARCHAR), i, 1)) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [CAST(0 AS BIGINT) FOR _ IN range(8)]),
        lambda v, _: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"""

OP13_SQL = f"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS place,
           md5(strlen(role) || ':' || role || text) AS code, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
    SELECT conv_id, conv_id - conv_id % {BLOCK} AS base, {_CRC.format(c="conv_id")} % {HEADS} AS h
    FROM (SELECT DISTINCT conv_id FROM turns)),
borrowed AS (
    SELECT c.conv_id, t.place, code, words FROM convs AS c JOIN turns AS t ON t.conv_id = c.base AND t.place <= c.h),
rebuilt AS (
    SELECT * FROM borrowed UNION ALL
    SELECT t.conv_id, t.place - c.h + (SELECT count(*) FROM borrowed AS b WHERE b.conv_id = t.conv_id), code, words
    FROM turns AS t JOIN convs AS c USING (conv_id) WHERE t.place > c.h),
paths AS (
    SELECT conv_id, 0 AS depth, '' AS path, 0 AS words FROM convs UNION ALL
    SELECT conv_id, place, string_agg(code, '') OVER (PARTITION BY conv_id ORDER BY place), words FROM rebuilt),
ends AS (SELECT path, conv_id FROM (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS deepest FROM paths) WHERE depth = deepest),
digests AS (SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS digest FROM ends GROUP BY path),
nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
           CASE WHEN depth > 0 THEN substr(path, 1, length(path) - 32) END AS parent
    FROM paths GROUP BY path, depth),
children AS (SELECT parent AS path, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
-- each node under all prefixes of its path
below AS (
    SELECT p.path, CAST(sum((n.n_convs - 1) * n.words) AS BIGINT) AS saved, count(*) FILTER (WHERE c.path IS NULL) AS leaves
    FROM nodes AS n JOIN paths AS p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN children AS c ON c.path = n.path
    GROUP BY p.path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       CAST(coalesce(c.n_children, 0) AS BIGINT) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves, b.saved AS saved_tokens,
       coalesce(d.digest, '{NOTHING}') AS ends_sha256
FROM nodes AS n LEFT JOIN nodes AS p ON p.path = n.parent LEFT JOIN children AS c ON c.path = n.path
JOIN below AS b ON b.path = n.path LEFT JOIN digests AS d ON d.path = n.path"""
