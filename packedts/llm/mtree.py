"""Exact top-k search by inner product with an M-tree.

Integer vectors become points of a metric space in which a larger inner product with a query
is a smaller distance: each vector gets one more component, sqrt(M - |x|^2) for the largest
squared length M, and each query a zero there; then d(q, x)^2 = |q|^2 + M - 2 q.x.

The root's routing objects are a bounded number of vectors (PIVOTS at most); a vector belongs
to the nearest. Below the root, cells of bounded size each hold their own nodes: pages with a
routing object, a covering radius, and the distance of every entry to it. A query first
searches the cell of its nearest routing object, which gives it a k-th score to beat. Then it
goes to the cells whose covering radius leaves room for that score. In a cell it takes
pages best first; stored distances to the page's routing object rule entries out by the
triangle inequality before their own distance is computed. What may tie is searched too,
unless all its ids are larger.

Crowded root entries are split into cells by a hash of vec_id and vector, so a vector that a
third of all rows repeat is spread out, and so are the vectors of a vec_id that has many. Only routing objects, radii and cell counts are broadcast.

Defined results: vectors that are null or hold null or non-finite components take no part, nor
rows with null vec_id, nor vectors whose squared length is LONGEST or more, as their scores need not fit
64 bits (those of all others do); shorter vectors count as continued by zeros; repeated rows (vec_id and vector)
count once, and a vec_id with several vectors has the largest inner product of any of them, as query
and as result (the SQL below lists rows, so it agrees where vec_id is unique); fewer than k candidates give fewer
rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packedts.llm.components import stored
from packedts.llm.vectors import matrix, once, padded, ranked, usable

PIVOTS = 64
CELL = 8192
PAGE = 64
SLACK = 1e-6
LONGEST = 2.0**61
FOUND = "query_id long, vec_id long, score long"


def lifted(x: np.ndarray, largest: int) -> np.ndarray:
    """Points for vectors: one more component makes all of them equally long."""
    return np.column_stack([x, np.sqrt(np.maximum(0, largest - (x * x).sum(1)))])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(0, square))


class Cell:
    """The pages of one cell."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, largest: int) -> None:
        points = lifted(x.astype(np.float64), largest)
        pages = -(-len(ids) // PAGE)
        routing = points[np.random.default_rng(7).permutation(len(ids))[:pages]]
        own = np.empty(len(ids), np.int64)
        for lo in range(0, len(ids), 2048):
            own[lo : lo + 2048] = distances(points[lo : lo + 2048], routing).argmin(1)
        order = np.lexsort((ids, own))
        own = own[order]
        self.ids, self.x = ids[order], x[order]
        self.starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        self.ends = np.append(self.starts[1:], len(ids))
        self.routing = routing[own[self.starts]]
        # distance of every entry to its page's routing object
        self.to_routing = np.sqrt(((points[order] - routing[own]) ** 2).sum(1))
        self.radius = np.maximum.reduceat(self.to_routing, self.starts)
        self.least_id = self.ids[self.starts]
        self.largest = largest

    def search(self, query_id: int, q: np.ndarray, k: int, floor: tuple[int, int], to_pages: np.ndarray) -> list[tuple[int, int]]:
        """The k best (score, -vec_id) above floor, the k-th best known so far, each vec_id once;
        to_pages are the distances of the query to the routing objects."""
        length = float(q @ q)
        best: list[tuple[int, int]] = []
        held: dict[int, int] = {}  # scores in best
        nearest = np.maximum(0, to_pages - self.radius)
        bound = (length + self.largest - nearest**2) / 2
        bound = np.floor(bound + SLACK * (1 + np.abs(bound))).astype(np.int64)
        for page in np.argsort(-bound, kind="stable"):
            limit = max(floor, best[0]) if len(best) == k else floor
            if bound[page] < limit[0]:
                break
            if (bound[page], -self.least_id[page]) <= limit:
                continue
            lo, hi = self.starts[page], self.ends[page]
            # an entry's distance is at least |d(q, routing) - d(entry, routing)|
            gap = np.abs(to_pages[page] - self.to_routing[lo:hi])
            reach = (length + self.largest - gap**2) / 2
            rows = lo + np.flatnonzero(reach + SLACK * (1 + np.abs(reach)) >= limit[0])
            score = self.x[rows] @ q
            keep = (score >= limit[0]) & (self.ids[rows] != query_id)
            for s, i in zip(score[keep].tolist(), self.ids[rows[keep]].tolist()):
                if (s, -i) <= floor or s <= held.get(i, s - 1):
                    continue
                if i in held:
                    best[best.index((held[i], -i))] = (s, -i)
                    heapq.heapify(best)
                elif len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    del held[-heapq.heapreplace(best, (s, -i))[1]]
                else:
                    continue
                held[i] = s
        return best


LOWEST = (-(1 << 62), -(1 << 62))


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id and score of the k largest inner products of every query.

    vectors has vec_id and vec, an array of integers; the queries are those of its rows for which is_query holds.
    """
    good = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "vec", is_query.alias("is_query"))
    good, length = padded(good.where("vec IS NOT NULL AND vec_id IS NOT NULL"), F.lit(0).cast("long"))
    inexact = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    good = stored(once(good.where(inexact < LONGEST)), "vectors")
    square = F.aggregate("vec", F.lit(0).cast("long"), lambda a, x: a + x * x)
    n, largest = good.agg(F.count(F.lit(1)), F.max(square)).first()
    if not n or not length:
        zero = good.select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
        return ranked(zero, k)
    chosen = good.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(min(PIVOTS, n // 256 + 1)).select("vec").collect()
    pivots = lifted(np.array([r.vec for r in chosen], np.float64), largest)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = distances(lifted(matrix(batch.column("vec"), length, np.float64), largest), pivots)
            pivot = away.argmin(1)
            columns = [batch.column("vec_id"), batch.column("vec"), batch.column("is_query"), pa.array(pivot.astype(np.int32)), pa.array(away.min(1))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vec", "is_query", "pivot", "away"])

    placed = stored(good.mapInArrow(assign, "vec_id long, vec array<long>, is_query boolean, pivot int, away double"), "placed")
    # the root: covering radius and number of cells of each routing object, PIVOTS rows at most
    root = placed.groupBy("pivot").agg(F.max("away").alias("radius"), F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("cells"))
    entries = {r.pivot: (r.radius, r.cells) for r in root.collect()}
    radius = np.array([entries.get(p, (-1.0, 0))[0] for p in range(len(pivots))])
    cells = F.broadcast(root.select("pivot", "cells"))
    index = placed.join(cells, "pivot").select(
        F.col("pivot").alias("i_pivot"), F.pmod(F.xxhash64("vec_id", "vec"), F.col("cells")).cast("int").alias("i_cell"), F.col("vec_id").alias("i_id"), F.col("vec").alias("i_vec")
    )

    def route(home: bool):
        """Rows (pivot, query) for the nearest routing object of each query, or for all others that may hold better."""

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = matrix(batch.column("vec"), length, np.float64)
                away = distances(np.column_stack([q, np.zeros(len(q))]), pivots)
                away[:, radius < 0] = np.inf
                first = away.argmin(1)
                if home:
                    row, pivot = np.arange(len(q)), first
                else:
                    reach = ((q * q).sum(1)[:, None] + largest - np.maximum(0, away - radius[None, :]) ** 2) / 2
                    floor = batch.column("floor").to_numpy(zero_copy_only=False)
                    may = (reach + SLACK * (1 + np.abs(reach)) >= floor[:, None]) & (radius >= 0)[None, :]
                    may[np.arange(len(q)), first] = False
                    row, pivot = np.nonzero(may)
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(pivot.astype(np.int32)), *taken.columns], names=["pivot", *batch.schema.names])

        return task

    def search(queries: pa.Table, members: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, int]] = []
        if queries.num_rows and members.num_rows:
            cell = Cell(members.column("i_id").to_numpy().astype(np.int64), matrix(members.column("i_vec"), length, np.int64), largest)
            q = matrix(queries.column("vec"), length, np.int64)
            known = zip(*(queries.column(c).to_pylist() for c in ("query_id", "floor", "floor_id")))
            for lo in range(0, len(q), 512):
                part = q[lo : lo + 512]
                to_pages = distances(np.column_stack([part, np.zeros(len(part))]).astype(np.float64), cell.routing)
                for vector, away in zip(part, to_pages):
                    query_id, floor, floor_id = next(known)
                    rows += [(query_id, -i, s) for s, i in cell.search(query_id, vector, k, (floor, floor_id), away)]
        columns = zip(*rows) if rows else [[]] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    key = ["pivot", "cell"]

    def searched(asked: DataFrame) -> DataFrame:
        spread = asked.join(cells, "pivot").withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).drop("cells")
        return spread.groupBy(*key).cogroup(index.groupBy("i_pivot", "i_cell")).applyInArrow(search, FOUND)

    fields = "query_id long, vec array<long>, floor long, floor_id long"
    queries = placed.where("is_query").select(
        F.col("vec_id").alias("query_id"), "vec", F.lit(LOWEST[0]).cast("long").alias("floor"), F.lit(LOWEST[1]).cast("long").alias("floor_id")
    )
    near = stored(ranked(searched(queries.mapInArrow(route(True), f"pivot int, {fields}")), k), "near")
    beaten = near.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"), (-F.col("vec_id")).alias("kth_id"))
    again = queries.join(beaten, "query_id", "left").select(
        "query_id", "vec", F.coalesce("kth", "floor").alias("floor"), F.coalesce("kth_id", "floor_id").alias("floor_id")
    )
    far = searched(again.mapInArrow(route(False), f"pivot int, {fields}"))
    return ranked(near.select("query_id", "vec_id", "score").unionByName(far), k)


def op3_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 largest inner products of floor(1024 x) for every vec_id divisible by 100."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(usable(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(1024.0) * x.cast("double")).cast("long"))
    return top_k(vectors.select("vec_id", whole.alias("vec")), F.col("vec_id") % 100 == 0, 10)


OP3_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND vec_id IS NOT NULL
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.vec, v.vec)::BIGINT AS score
  FROM vectors q JOIN vectors v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""
