"""Approximate nearest neighbours by cross-polytope hashing.

A table turns unit vectors by a pseudo-rotation (random signs and a fast Hadamard transform,
three times) and files each under its nearest signed axis. A query probes, in every table,
the axes that come next as well. Each axis of a table is one group: the vectors filed there
and the queries that probe it meet in one task, which reranks all of them exactly by cosine
and passes on the best few per query.

Crowded axes are split into parts of bounded size, and their queries go to every part; the
number of parts follows from a count of at most tables * 2 * dimensions rows, which is the
bound of that broadcast. No candidate is dropped.

Recall on the tables at hand is stated in the README and tested.

Defined results: vectors that are null, zero, or hold null or non-finite components take no
part; shorter vectors count as continued by zeros; repeated rows (vec_id and vector)
count once, and a vec_id with several vectors has its best score, as query and as result; fewer than k candidates give fewer rows; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packedts.llm.components import stored
from packedts.llm.vectors import matrix, once, padded, ranked, usable


@dataclass(frozen=True)
class Hashing:
    tables: int = 14
    probes: int = 8
    part: int = 4096
    seed: int = 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row, scaled to keep lengths."""
    n, width = x.shape
    h = 1
    while h < width:
        pairs = x.reshape(n, -1, 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, width)
        h *= 2
    return x / np.sqrt(width)


def axes(x: np.ndarray, table: int, hashing: Hashing, probes: int) -> np.ndarray:
    """The nearest signed axes of every row under a table's pseudo-rotation, nearest first."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    signs = np.random.default_rng([hashing.seed, table, width]).choice([-1.0, 1.0], (3, width))
    y = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    for s in signs:
        y = hadamard(y * s)
    both = np.concatenate([y, -y], 1)
    return np.argsort(-both, 1, kind="stable")[:, :probes]


def _filed(vectors: DataFrame, length: int, hashing: Hashing, probes: int) -> DataFrame:
    """A row (table, axis, vec_id, vec) for each table and probed axis of every vector."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), length, np.float64)
            unit = x / np.sqrt((x / np.abs(x).max(1, keepdims=True)) ** 2 @ np.ones((length, 1))) / np.abs(x).max(1, keepdims=True)
            for table in range(hashing.tables):
                axis = axes(unit, table, hashing, probes)
                for probe in range(axis.shape[1]):
                    columns = [pa.array(np.full(len(x), table, np.int32)), pa.array(axis[:, probe].astype(np.int32)), batch.column(0), batch.column(1)]
                    yield pa.RecordBatch.from_arrays(columns, names=["table", "axis", "vec_id", "vec"])

    return vectors.mapInArrow(task, "table int, axis int, vec_id long, vec array<double>")


def cosines(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines of all rows with all rows, summed component by component, so that equal vectors
    get equal scores wherever they stand.

    Each row is scaled by a power of two first, which changes no digit, so that no square over- or underflows."""
    queries, vectors = (np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0.0))[1][:, None]) for x in (queries, vectors))
    dot = np.zeros((len(queries), len(vectors)))
    squares = [np.zeros(len(queries)), np.zeros(len(vectors))]
    for k in range(queries.shape[1]):
        dot += queries[:, k, None] * vectors[None, :, k]
        squares[0] += queries[:, k] ** 2
        squares[1] += vectors[:, k] ** 2
    return dot / (np.sqrt(squares[0])[:, None] * np.sqrt(squares[1])[None, :])


def best_of(scores: np.ndarray, query_ids: np.ndarray, vec_ids: np.ndarray, k: int) -> pa.Table:
    """The k best of each row but the query itself, each vec_id once with its best score.

    vec_ids do not fall, so ties go to the smaller one.
    """
    starts = np.flatnonzero(np.append(True, vec_ids[1:] != vec_ids[:-1]))
    scores, vec_ids = np.maximum.reduceat(scores, starts, axis=1), vec_ids[starts]
    scores = np.where(query_ids[:, None] == vec_ids[None, :], -np.inf, scores)
    order = np.argsort(-scores, 1, kind="stable")[:, :k]
    top = np.take_along_axis(scores, order, 1)
    row, column = np.nonzero(top > -np.inf)
    return pa.table({"query_id": query_ids[row], "vec_id": vec_ids[order[row, column]], "score": top[row, column]})


def nearest(vectors: DataFrame, is_query: Column, k: int, hashing: Hashing | None = None) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for every query.

    vectors has vec_id and embedding; the queries are those of its rows for which is_query holds.
    """
    hashing = hashing or Hashing()
    vec = F.transform("embedding", lambda x: x.cast("double"))
    good = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"), is_query.alias("is_query"))
        .where(usable(F.col("vec")) & F.exists("vec", lambda x: x != 0) & F.col("vec_id").isNotNull())
    )
    good, length = padded(good, F.lit(0.0))
    good = stored(once(good), "vectors")
    filed = _filed(good.select("vec_id", "vec"), length, hashing, 1)
    probed = _filed(good.where("is_query").select("vec_id", "vec"), length, hashing, hashing.probes)
    parts = filed.groupBy("table", "axis").agg(F.ceil(F.count(F.lit(1)) / hashing.part).cast("int").alias("parts"))
    parts = F.broadcast(parts)  # at most tables * 2 * padded length rows
    index = filed.join(parts, ["table", "axis"]).withColumn("part", F.pmod(F.xxhash64("vec_id", "vec"), F.col("parts")).cast("int"))
    asked = probed.join(parts, ["table", "axis"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    schema = "query_id long, vec_id long, score double"

    def rerank(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        candidates = candidates.sort_by("vec_id")
        ids, x = candidates.column("vec_id").to_numpy().astype(np.int64), matrix(candidates.column("vec"), length, np.float64)
        tables = [pa.table({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})]
        if candidates.num_rows:
            for lo in range(0, queries.num_rows, 256):
                some = queries.slice(lo, 256)
                scores = cosines(matrix(some.column("vec"), length, np.float64), x)
                tables.append(best_of(scores, some.column("vec_id").to_numpy().astype(np.int64), ids, k))
        return pa.concat_tables(tables)

    key = ["table", "axis", "part"]
    asked = asked.select(*key, F.col("vec_id"), "vec")
    index = index.select(*(F.col(c).alias(f"i_{c}") for c in key), F.col("vec_id").alias("vec_id"), F.col("vec").alias("vec"))
    found = asked.groupBy(*key).cogroup(index.groupBy(*(f"i_{c}" for c in key))).applyInArrow(rerank, schema)
    return ranked(found, k)


def op8_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest by cosine found for every vec_id divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.col("vec_id") % 50 == 0, 5)
