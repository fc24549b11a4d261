"""Blocks of documents and buckets of keys, the two ways in which the substring operators deal out work.

A block holds the documents of one hash value of (doc_id, text), a few megabytes of text. A
bucket holds the keys of one range of hash values. Blocks send arrays of keys to buckets,
buckets answer to blocks; both are plain groupings by a number, so Spark deals them out,
retries them and spills between them. All passes over the blocks group the same rows in the
same way, so one plan shuffles the texts once and reuses that exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Layout:
    """How many blocks and buckets; from the bytes of all texts, so that either stays bounded."""

    blocks: int
    buckets: int

    @staticmethod
    def of(texts: DataFrame, block_bytes: int = 2 << 20, bucket_bytes: int = 8 << 20) -> Layout:
        total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        scale = max(1.0, total / (1 << 45))  # past 32 TB both grow, so that their product grows no faster than the text
        return Layout(int(total // (block_bytes * scale)) + 1, int(total // (bucket_bytes * scale)) + 1)


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id and text, a null text empty; other columns are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def blocked(texts: DataFrame, layout: Layout) -> DataFrame:
    return texts.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(layout.blocks)).alias("block"), "doc_id", "text")


def in_id_order(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The documents of a block by doc_id, nulls last, and their ids with NO_ID for null."""
    table = table.sort_by("doc_id")
    return table, table.column("doc_id").combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def joined(column: pa.ChunkedArray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all binary values of a column, and how many each value holds."""
    values = [np.frombuffer(v.as_buffer(), dtype) if v.is_valid else np.zeros(0, dtype) for chunk in column.chunks for v in chunk]
    return (np.concatenate(values) if values else np.zeros(0, dtype)), np.array([len(v) for v in values], np.int64)


def dealt(of: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """Rows (number, bytes of each column) for each number in of; of is sorted."""
    if not len(of):
        return
    at = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    for lo, hi in zip(at, np.append(at[1:], len(of))):
        yield (int(of[lo]), *(c[lo:hi].tobytes() for c in columns))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key; grows with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def rows_table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def per_block(blocks: DataFrame, answers: DataFrame, f: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """f of each block's documents and of the answers that buckets gave to it."""
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(f, schema)
