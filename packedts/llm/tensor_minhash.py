"""MinHash near-deduplication with tensored banding.

A document's set holds the distinct hashes of its runs of `words` words. Two small
collections of bands are computed, U with `u_bands` bands of `u_rows` minima and V with
`v_bands` of `v_rows`; every pair of a band of U and one of V is a table, so u_bands * v_bands
tables cost u_bands * u_rows + v_bands * v_rows minima. Two sets of similarity s meet in a
table unless they share no band of U or none of V: at s = 0.8 and the default sizes the chance
of that is 2 in 100,000.

1. Documents with equal sets are one class, standing for itself by its least doc_id.
2. Classes that meet in a table form candidate groups (components). Links are formed per batch
   first, then between batches, so an entry that a third of all classes share arrives as one
   row per batch, and each sends on no more links than it has classes.
3. In a group every class is compared with the group's least class (the leader) on full sets.
   Those not linked to it are compared with all others of the group, in pieces of bounded
   size. So every pair of a group is either linked through the leader or compared.
4. Components of the confirmed links give each document the least doc_id that it can reach.

Two sets are linked if 100 * |intersection| >= percent * |union|. Sets are compared by 64-bit
hashes of shingles.

Defined results: a null text is empty; a document without words has n_shingles 0 and is
linked with nothing; fewer words than `words` are one shingle; a row with null doc_id is linked with
nothing and kept; rows with equal doc_id count as one document; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packedts.llm.batches import small_batches
from packedts.llm.blocks import Layout, bucket_of, dealt, joined, rows_table
from packedts.llm.components import components, stored
from packedts.llm.textbytes import LOWER, ODD, gram_hashes, groups, mixed, ranges, text_bytes, word_hashes, word_spans

PIECE = 1024
SLAB = 4096
SLICE = 500
BATCH = 4000
CROWD, CROWD_SHARE = 4096, 16_384


@dataclass(frozen=True)
class Tables:
    """Sizes of the two collections."""

    u_bands: int = 16
    u_rows: int = 3
    v_bands: int = 16
    v_rows: int = 3

    @property
    def minima(self) -> int:
        return self.u_bands * self.u_rows + self.v_bands * self.v_rows


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts one after the other, sorted in each, and their counts."""
    data, starts, ends = text_bytes(texts)
    data = LOWER[data]
    first, last, doc = word_spans(data, starts, ends)
    hashes = word_hashes(data, first, last)
    count = np.bincount(doc, minlength=len(starts))
    begin = np.cumsum(count) - count
    left = count[doc] - (np.arange(len(doc)) - begin[doc])
    full = np.flatnonzero(left >= words)
    values, owner = gram_hashes(hashes, words)[full], doc[full]
    for size in range(1, words):  # texts with fewer words
        short = np.flatnonzero(count == size)
        if len(short):
            values = np.append(values, gram_hashes(hashes, size)[begin[short]] ^ ODD[30 + size % 8])
            owner = np.append(owner, short)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.bincount(owner[new], minlength=len(starts))


def minima(values: np.ndarray, count: np.ndarray, tables: Tables) -> np.ndarray:
    """The least value of each set, none empty, under each of the hash functions."""
    factors = np.random.default_rng(8191).integers(0, 1 << 63, tables.minima, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    begin = np.cumsum(count) - count
    return np.stack([np.minimum.reduceat(values * f ^ (values * f >> np.uint64(31)), begin) for f in factors], 1)


def _bands(part: np.ndarray, rows: int) -> np.ndarray:
    """A hash of each band of a collection."""
    out = np.zeros((len(part), part.shape[1] // rows), np.uint64)
    for r in range(rows):
        out = mixed(out * ODD[2] + part[:, r::rows])
    return out


def table_keys(least: np.ndarray, tables: Tables) -> np.ndarray:
    """A key for each pair of a band of U and a band of V."""
    u = _bands(least[:, : tables.u_bands * tables.u_rows], tables.u_rows)
    v = _bands(least[:, tables.u_bands * tables.u_rows :], tables.v_rows)
    number = np.arange(tables.u_bands * tables.v_bands, dtype=np.uint64).reshape(tables.u_bands, -1)
    return mixed(u[:, :, None] * ODD[3] + v[:, None, :] * ODD[4] + number * ODD[5]).reshape(len(least), -1)


def signatures(texts: DataFrame, words: int, tables: Tables) -> DataFrame:
    """doc_id, n (size of the set), a 128-bit hash of the set, and its minima."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("minima", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                values, count = shingle_sets(part.column("text"), words)
                some = np.flatnonzero(count)
                least = minima(values, count[some], tables)
                sums = np.zeros((2, len(count)), np.uint64)
                begin = (np.cumsum(count) - count)[some]
                for k, code in enumerate((mixed(values * ODD[6]), mixed(values ^ ODD[7]) * ODD[8])):
                    sums[k, some] = np.add.reduceat(code, begin) if len(some) else 0
                signature: list = [None] * len(count)
                for k, row in zip(some, least):
                    signature[k] = row.tobytes()
                columns = [part.column("doc_id"), pa.array(count), *(pa.array(s.view(np.int64)) for s in sums), pa.array(signature, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return texts.mapInArrow(task, "doc_id long, n long, set_a long, set_b long, minima binary")


def _stars(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The place of the least id of each distinct key, and links from that id to the others of its key."""
    order = np.lexsort((ids, keys))
    sorted_ids = ids[order]
    at = groups(keys[order])
    centre = np.repeat(sorted_ids[at], np.diff(np.append(at, len(keys))))
    other = centre != sorted_ids
    return order[at], centre[other], sorted_ids[other]


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of links (a, b), sorted, and the least id that each can reach."""
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    root = np.arange(len(ids))
    while len(apart := np.flatnonzero(root[a] != root[b])):
        a, b = a[apart], b[apart]
        x, y = root[a], root[b]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while ((up := root[root]) != root).any():
            root = up
    return ids, ids[root]


def band_places(least: np.ndarray, tables: Tables) -> np.ndarray:
    """A number for each band of U, by which the keys of its tables are dealt to buckets."""
    u = _bands(least[:, : tables.u_bands * tables.u_rows], tables.u_rows)
    return mixed(u * ODD[9] + np.arange(tables.u_bands, dtype=np.uint64) * ODD[5])


def crowded_bands(classes: DataFrame, tables: Tables) -> np.ndarray:
    """The places that more than CROWD classes and more than 1 in CROWD_SHARE hold, sorted.

    So at most u_bands * CROWD_SHARE numbers come to the driver, whatever the input.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = np.frombuffer(b"".join(batch.column("minima").to_pylist()), "<u8").reshape(batch.num_rows, -1)
            places, count = np.unique(band_places(least, tables), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(places.view(np.int64)), pa.array(count)], names=["place", "n"])

    counts = classes.select("minima").mapInArrow(task, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    least_rows = max(CROWD, classes.count() // CROWD_SHARE)
    rows = counts.where(F.col("n") > least_rows).select("place").collect()
    return np.sort(np.array([r.place for r in rows], np.int64).view(np.uint64))


def candidate_links(classes: DataFrame, tables: Tables, layout: Layout) -> DataFrame:
    """Links (a, b) whose components are those of all classes (doc_id, minima) that meet in a table.

    A batch links its own classes first and files each key under the least class of its
    component. Keys are dealt by their band of U, so a pair that meets in many tables is found
    in few buckets, however many there are; keys of a crowded band are dealt one by one. Batches
    and buckets send on one link for each class that is not the least of its component there.
    """
    rows = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("ids", pa.binary()), ("a", pa.binary()), ("b", pa.binary())])
    sent = "bucket long, keys binary, ids binary, a binary, b binary"
    buckets = layout.buckets
    crowded = crowded_bands(classes, tables)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                least = np.frombuffer(b"".join(part.column("minima").to_pylist()), "<u8").reshape(len(ids), -1)
                keys = table_keys(least, tables)
                per_class = keys.shape[1]
                keys = keys.ravel()
                at, a, b = _stars(keys, np.repeat(ids, per_class))
                linked, root = _roots(a, b)
                place = band_places(least, tables)[at // per_class, at % per_class // tables.v_bands]
                keys, ids = keys[at], ids[at // per_class]
                if len(linked):
                    spot = np.minimum(np.searchsorted(linked, ids), len(linked) - 1)
                    ids = np.where(linked[spot] == ids, root[spot], ids)
                if len(crowded):
                    spot = np.minimum(np.searchsorted(crowded, place), len(crowded) - 1)
                    place = np.where(crowded[spot] == place, keys, place)
                bucket = bucket_of(place, buckets)
                order = np.argsort(bucket, kind="stable")
                out = [(n, k, i, None, None) for n, k, i in dealt(bucket[order], keys[order], ids[order])]
                other = linked != root
                if other.any():  # links within the batch go along with some bucket
                    out.append((int(linked[0]) % buckets, b"", b"", root[other].tobytes(), linked[other].tobytes()))
                yield from rows_table(out, rows).to_batches()

    def meet(table: pa.Table) -> pa.Table:
        keys, ids = joined(table.column("keys"), "<u8")[0], joined(table.column("ids"), "<i8")[0]
        _, a, b = _stars(keys, ids)
        a, b = (np.concatenate([x, joined(table.column(c), "<i8")[0]]) for x, c in ((a, "a"), (b, "b")))
        linked, root = _roots(a, b)
        other = linked != root
        return pa.table({"a": root[other], "b": linked[other]})

    return classes.mapInArrow(task, sent).groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


def _set_rows(texts: DataFrame, words: int) -> DataFrame:
    """The rows of texts with set, the sorted hashes of their shingles, in place of text."""
    kept = [f for f in texts.schema.fields if f.name != "text"]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", set binary"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                values, count = shingle_sets(part.column("text"), words)
                ends = np.cumsum(count)
                sets = [values[e - c : e].tobytes() for c, e in zip(count, ends)]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), pa.array(sets, pa.binary())], names=[*(f.name for f in kept), "set"])

    return texts.mapInArrow(task, ddl)


def _linked(common: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """size: the sum of both sizes."""
    return 100 * common >= percent * (size - common)


def compare_with_leader(members: pa.Table, leader: pa.Table, percent: int) -> pa.Table:
    """id, leader and whether the two are linked, for the members of one piece of a group."""
    ids = members.column("id").to_numpy()
    if not len(ids) or not leader.num_rows:
        return pa.table({"id": pa.array([], pa.int64()), "leader": pa.array([], pa.int64()), "linked": pa.array([], pa.bool_())})
    values, count = joined(members.column("set"), "<u8")
    head = joined(leader.column("set").slice(0, 1), "<u8")[0]
    hit = head[np.minimum(np.searchsorted(head, values), len(head) - 1)] == values
    total = np.append(0, np.cumsum(hit))
    ends = np.cumsum(count)
    common = total[ends] - total[ends - count]
    return pa.table({"id": ids, "leader": members.column("leader").to_numpy(), "linked": _linked(common, count + len(head), percent)})


def common_counts(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """|intersection| of each set on the left with each on the right; sets as values and counts.

    Only values on both sides matter. They are the columns of two 0/1 matrices, which are
    multiplied in slabs of SLAB columns.
    """
    values = np.intersect1d(np.unique(left[0]), np.unique(right[0]))
    out = np.zeros((len(left[1]), len(right[1])), np.float32)
    sides = []
    for v, count in (left, right):
        column = np.minimum(np.searchsorted(values, v), max(0, len(values) - 1))
        hit = values[column] == v if len(values) else np.zeros(len(v), bool)
        row, column = np.repeat(np.arange(len(count)), count)[hit], column[hit]
        order = np.argsort(column, kind="stable")
        sides.append((row[order], column[order], len(count)))
    for lo in range(0, len(values), SLAB):
        slabs = []
        for row, column, n in sides:
            a, b = np.searchsorted(column, (lo, lo + SLAB))
            slab = np.zeros((n, min(SLAB, len(values) - lo)), np.float32)
            slab[row[a:b], column[a:b] - lo] = 1
            slabs.append(slab)
        out += slabs[0] @ slabs[1].T
    return out.astype(np.int64)


def compare_pieces(odd: pa.Table, members: pa.Table, percent: int) -> pa.Table:
    """Links (a, b) between the classes of two pieces, as a forest."""
    pairs: list[tuple[int, int]] = []
    if odd.num_rows and members.num_rows:
        left, right = joined(odd.column("set"), "<u8"), joined(members.column("values"), "<u8")
        hit = _linked(common_counts(left, right), left[1][:, None] + right[1][None, :], percent)
        a, b = odd.column("id").to_numpy(), members.column("other").to_numpy()
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = root[up] if up in root else up
                x = up
            return x

        for i, j in zip(*np.nonzero(hit)):
            x, y = find(int(a[i])), find(int(b[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                pairs.append((int(a[i]), int(b[j])))
    return rows_table(pairs, pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def confirmed_links(texts: DataFrame, candidates: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) whose components are those of all links within candidate groups (id, root)."""
    size = candidates.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    groups_ = stored(
        candidates.join(size, "root").select("id", F.col("root").alias("leader"), "members", F.ceil(F.col("members") / PIECE).cast("long").alias("pieces")),
        "groups",
    )
    # by sorting at every size: the ids of all candidates are not bounded, so they are not broadcast
    wanted = texts.join(groups_.hint("merge"), texts.doc_id == groups_.id).drop("doc_id")
    sets = stored(_set_rows(wanted.select("id", "leader", "members", "pieces", "text"), words), "sets")
    piece = F.pmod(F.xxhash64("id"), F.col("pieces"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))

    members = sets.where("id <> leader").select("id", "leader", piece.alias("piece"), "set")
    leaders = sets.where("id = leader").select("leader", every.alias("piece"), "set")
    verdicts = stored(
        members.groupBy("leader", "piece")
        .cogroup(leaders.groupBy("leader", "piece"))
        .applyInArrow(lambda m, l: compare_with_leader(m, l, percent), "id long, leader long, linked boolean"),
        "verdicts",
    )

    # classes that are not linked to their leader, against all others of the group
    odd_ids = verdicts.where("NOT linked").select("id")
    odd = sets.where("members > 2").join(odd_ids, "id", "left_semi")
    odd_groups = odd.select("leader").distinct()
    others = sets.where("members > 2").join(odd_groups, "leader", "left_semi")
    left = odd.select("id", "leader", piece.alias("p"), every.alias("q"), "set")
    right = others.select(F.col("id").alias("other"), F.col("leader").alias("of"), every.alias("p"), piece.alias("q"), F.col("set").alias("values"))
    across = (
        left.groupBy("leader", "p", "q")
        .cogroup(right.groupBy("of", "p", "q"))
        .applyInArrow(lambda o, m: compare_pieces(o, m, percent), "a long, b long")
    )
    return verdicts.where("linked").select(F.col("leader").alias("a"), F.col("id").alias("b")).union(across)


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, tables: Tables | None = None, layout: Layout | None = None
) -> DataFrame:
    """doc_id, n_shingles, class_id (least doc_id with the same set), component_id and kept."""
    small_batches(docs.sparkSession)
    spark, tables = docs.sparkSession, tables or Tables()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    layout = layout or Layout.of(texts)
    signed = stored(signatures(texts, words, tables), "signatures")
    linkable = signed.where("n > 0 AND doc_id IS NOT NULL")
    # equal sets; the partial minimum keeps one row per set and task before the shuffle
    classes = stored(
        linkable.groupBy("set_a", "set_b").agg(F.min(F.struct("doc_id", "minima")).alias("first")).select("set_a", "set_b", "first.doc_id", "first.minima"),
        "classes",
    )
    candidates = components(spark, candidate_links(classes.select("doc_id", "minima"), tables, layout))
    links = confirmed_links(texts, candidates, words, percent)
    roots = components(spark, links)
    named = classes.select("set_a", "set_b", F.col("doc_id").alias("class_id")).join(
        roots.withColumnRenamed("id", "class_id"), "class_id", "left"
    )
    component = F.coalesce("root", "class_id", "doc_id")
    return (
        signed.drop("minima")
        .withColumn("linkable", F.expr("n > 0 AND doc_id IS NOT NULL"))
        .join(named.withColumn("linkable", F.lit(True)), ["set_a", "set_b", "linkable"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("class_id", "doc_id").alias("class_id"),
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )


def op10_tensor_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on 2-word shingles at similarity 0.8."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, words=2, percent=80).select("doc_id", "n_shingles", "component_id", "kept")
