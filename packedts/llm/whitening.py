"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Entries c become whole numbers x = floor(64 c) + 1000000. Count and sums of the x-vectors are
exact. Their scatter matrix is taken about the whole part of the mean, so that nothing large is
multiplied, and the fraction left over is taken off as one outer product. The matrix, d x d whatever
the number of rows, is factored by Cholesky with diagonal pivoting, which also tells its rank;
one-sided Jacobi then turns the columns of the triangular factor until they are orthogonal. Their
squared lengths are the eigenvalues and the columns, scaled to length one, the eigenvectors. No
product of the factor with itself is formed, so small eigenvalues keep their digits.

Scale: four narrow passes over the vectors (sums; scatter; the whitened covariance as a check;
the result) and no shuffle of vectors. Each task sends d (d + 1) / 2 numbers per matrix, which
Spark adds up before and after the shuffle; d (d + 1) / 2 numbers reach the driver.

Defined results: vectors that are null or hold null or non-finite entries take no part, nor do those
with an entry of LARGEST or more in size, whose x has no exact form here; shorter vectors
are continued by zeros; repeated rows count and are returned each, rows without vec_id too; directions
without variance (beyond rounding, 1e-13 of the largest eigenvalue per dimension) are no
components, so fewer than k may come, and none for a single vector; a deviation beyond 64 bits is
null; the largest entry of each component is positive; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packedts.llm.vectors import matrix, padded, usable

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**44
ROWS = 4096
MOST_SWEEPS = 60


# --- the matrix --------------------------------------------------------------------------


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pivots, and the trapezoidal factor L: a[order][:, order] = L @ L.T, as many columns as the rank."""
    a = a.copy()
    d = len(a)
    order = np.arange(d)
    factor = np.zeros((d, d))
    least = d * np.finfo(float).eps * max(float(np.diag(a).max(initial=0.0)), 0.0)
    for k in range(d):
        p = k + int(np.argmax(np.diag(a)[k:]))
        if a[p, p] <= least:
            return order, factor[:, :k]
        for m in (a, a.T, factor):
            m[[k, p]] = m[[p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = math.sqrt(a[k, k])
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return order, factor


def _rounds(columns: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of columns once, in rounds of disjoint pairs (the circle method)."""
    n = columns + columns % 2
    ring = np.arange(1, n)
    for _ in range(n - 1):
        seats = np.append(0, ring)
        p, q = seats[: n // 2], seats[n // 2 :][::-1]
        real = np.maximum(p, q) < columns
        yield np.minimum(p, q)[real], np.maximum(p, q)[real]
        ring = np.roll(ring, 1)


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """factor with its columns rotated among each other until all are orthogonal (one-sided Jacobi)."""
    g = factor.copy()
    exact = np.finfo(float).eps * max(1, g.shape[1])
    for _ in range(MOST_SWEEPS):
        turned = False
        for p, q in _rounds(g.shape[1]):
            left, right = g[:, p], g[:, q]
            a, b, c = (left * left).sum(0), (right * right).sum(0), (left * right).sum(0)
            off = np.abs(c) > exact * np.sqrt(a * b)
            if not off.any():
                continue
            turned = True
            p, q, left, right, a, b, c = p[off], q[off], left[:, off], right[:, off], a[off], b[off], c[off]
            zeta = (b - a) / (2 * c)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            cosine = 1 / np.sqrt(1 + t * t)
            g[:, p], g[:, q] = cosine * (left - t * right), cosine * (t * left + right)
        if not turned:
            break
    return g


def principal(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors (columns) of a positive semidefinite matrix, those without variance left out."""
    order, factor = pivoted_cholesky(scatter)
    columns = orthogonal_columns(factor)
    values = (columns * columns).sum(0)
    by_value = np.argsort(-values, kind="stable")
    values, columns = values[by_value], columns[:, by_value]
    held = values > 1e-13 * len(scatter) * values.max(initial=0.0)
    vectors = np.zeros((len(scatter), int(held.sum())))
    vectors[order] = columns[:, held] / np.sqrt(values[held])
    largest = np.abs(vectors).argmax(axis=0) if vectors.size else np.zeros(0, int)
    return values[held], vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])


# --- passes over the vectors ---------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    """Count, sums and components of the x-vectors of a table."""

    n: int
    sums: list[int]
    values: np.ndarray  # of the covariance
    vectors: np.ndarray
    trace: float

    @property
    def whole(self) -> np.ndarray:
        """The whole part of the mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """n times what the whole part leaves of the mean."""
        return [s % self.n for s in self.sums]

    def whitened(self, x: np.ndarray, k: int) -> np.ndarray:
        fraction = np.array([r / self.n for r in self.rest])
        return ((x - self.whole) - fraction) @ (self.vectors[:, :k] / np.sqrt(self.values[:k]))


def _usable(vectors: DataFrame, vector: str) -> Column:
    return usable(F.col(vector)) & F.forall(vector, lambda c: F.abs(c.cast("double")) < LARGEST)


def _numbers(batch: pa.RecordBatch, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """x-vectors of a batch in blocks of bounded size, and where each begins."""
    rows = max(1, min(ROWS, (1 << 20) // max(1, length)))
    for lo in range(0, batch.num_rows, rows):
        c = matrix(batch.column("vec").slice(lo, rows), length, np.float64)
        yield lo, np.floor(SCALE * c).astype(np.int64) + SHIFT


def _sums(vectors: DataFrame, length: int) -> tuple[int, list[int]]:
    """Number of vectors and the sums of their x, exact."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * length
        for batch in batches:
            for _, x in _numbers(batch, length):
                n += len(x)
                sums = [s + int(t) for s, t in zip(sums, x.sum(axis=0))]
        if n:
            # decimals of 38 digits hold any sum of a task
            yield pa.RecordBatch.from_arrays(
                [pa.array([*range(length), -1], pa.int32()), pa.array([*map(str, sums), str(n)], pa.string())], names=["i", "v"]
            )

    total = vectors.select("vec").mapInArrow(task, "i int, v string").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    held = {r.i: int(r.v) for r in total.collect()}
    return held.get(-1, 0), [held.get(i, 0) for i in range(length)]


def _products(vectors: DataFrame, length: int, of, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sums of of(x), an array of `size` numbers per vector, and of its outer products."""
    i, j = np.tril_indices(size)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products, any_ = np.zeros(size), np.zeros((size, size)), False
        for batch in batches:
            for _, x in _numbers(batch, length):
                y = of(x)
                sums += y.sum(axis=0)
                products += y.T @ y
                any_ = True
        if any_:
            columns = [np.append(i, np.arange(size)), np.append(j, np.full(size, -1)), np.append(products[i, j], sums)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.float64()))], names=["i", "j", "v"])

    total = vectors.select("vec").mapInArrow(task, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j, v = (total.column(c).to_numpy() for c in ("i", "j", "v"))
    sums, products = np.zeros(size), np.zeros((size, size))
    sums[i[j < 0]] = v[j < 0]
    i, j, v = i[j >= 0], j[j >= 0], v[j >= 0]
    products[i, j] = products[j, i] = v
    return sums, products


def fit(vectors: DataFrame, length: int) -> Fit | None:
    """The fit over all vectors (vec), each of the given length; None without any."""
    n, sums = _sums(vectors, length)
    if not n or not length:
        return None
    whole = np.array([s // n for s in sums], np.int64)
    _, products = _products(vectors, length, lambda x: (x - whole).astype(float), length)
    left = np.array([(s % n) / n for s in sums])
    scatter = products / n - np.outer(left, left)
    values, components = principal(scatter)
    return Fit(n, sums, values, components, float(np.trace(scatter)))


def identity_error(vectors: DataFrame, length: int, fitted: Fit, k: int) -> float:
    """How far the covariance of the whitened vectors is from the identity, measured on all of them."""
    sums, products = _products(vectors, length, lambda x: fitted.whitened(x, k), k)
    mean = sums / fitted.n
    return float(np.abs(products / fitted.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def deviations(x: np.ndarray, fitted: Fit) -> list[int | None]:
    """The exact sum over the dimensions of (n x - S)^2, None beyond 64 bits."""
    away, rest, n = x - fitted.whole, fitted.rest, fitted.n
    far = int(np.abs(away).max(initial=0))
    if far * max(far, n) * x.shape[1] >= 1 << 62:
        away, factors = away.astype(object), np.array(rest, object)
    else:
        factors = np.array(rest, np.int64)
    squares, mixed = (away * away).sum(axis=1).tolist(), (away * factors).sum(axis=1).tolist()
    fixed = sum(r * r for r in rest)
    # n x - S = n (x - whole) - rest
    totals = (n * n * s - 2 * n * m + fixed for s, m in zip(squares, mixed))
    return [t if t < 1 << 63 else None for t in totals]


def whiten(docs: DataFrame, k: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: a row per vector and component, k at most."""
    spark = docs.sparkSession
    held = docs.where(_usable(docs, vector)).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    held, length = padded(held, F.lit(0.0))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fitted = fit(held, length)
    if fitted is None or not len(fitted.values):
        return spark.createDataFrame([], schema)
    k = min(k, len(fitted.values))
    error = identity_error(held, length, fitted, k)
    explained = fitted.values[:k] / fitted.trace

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, x in _numbers(batch, length):
                rows = np.repeat(np.arange(lo, lo + len(x)), k)
                columns = [
                    batch.column("vec_id").take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(rows), fitted.n)),
                    pa.array(deviations(x, fitted), pa.int64()).take(pa.array(rows - lo)),
                    pa.array(fitted.whitened(x, k).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(rows), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return held.mapInArrow(task, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of all embeddings."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
