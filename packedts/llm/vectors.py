"""What the two vector searches share: usable vectors, their Arrow form, and the final ranking."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(column: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(column.isNotNull() & finite, F.lit(False))


def padded(vectors: DataFrame, zero: Column) -> tuple[DataFrame, int]:
    """vectors (vec_id, vec) with shorter ones continued by zeros, and the common length."""
    length = vectors.agg(F.max(F.size("vec"))).first()[0] or 0
    missing = F.array_repeat(zero, F.lit(length) - F.size("vec"))
    return vectors.withColumn("vec", F.when(F.size("vec") < length, F.concat("vec", missing)).otherwise(F.col("vec"))), length


def once(vectors: DataFrame) -> DataFrame:
    """vectors (vec_id, vec, is_query) with repeated rows as one; it is a query if any of them is."""
    return vectors.groupBy("vec_id", "vec").agg(F.max("is_query").alias("is_query"))


def matrix(column: pa.ChunkedArray | pa.Array, length: int, dtype: type) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten() if len(column) else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), length)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best, ties to the smaller vec_id."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
