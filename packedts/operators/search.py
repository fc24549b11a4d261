"""Which files hold points of a metric and device in a time range."""

from __future__ import annotations

import math
from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packedts.operators.cellparts import base_time_bytes, has_key_shape, metric_id_bytes
from packedts.operators.decode import decode_cells, decode_points, explode_points, raise_errors
from packedts.operators.fileindex import files_with, indexed_series
from packedts.operators.instants import as_utc, instant
from packedts.operators.lookup import BROADCAST_BYTES
from packedts.operators.series import COMPACT_BYTES
from packedts.schemas import MAX_OFFSET, TIME_BYTES
from packedts.sources.cells import read_cells


def point_filter(metric: str, lsp_id: int, start: str | datetime, end: str | datetime) -> Column:
    """Points of a metric and device with ``start <= time <= end``."""
    return (
        (F.col("metric") == metric)
        & (F.col("lsp_id") == lsp_id)
        & F.col("time").between(instant(start), instant(end))
    )


def files_of(points: DataFrame) -> DataFrame:
    """Distinct files of points decoded with provenance."""
    return points.select("file").distinct()


def _after(key: bytes) -> bytes | None:
    """The least key of the same length above ``key``, if there is one."""
    above = int.from_bytes(key, "big") + 1
    return above.to_bytes(len(key), "big") if above < 256 ** len(key) else None


def _stored_ids(uids: DataFrame, metric: str, id_size: int) -> DataFrame:
    """Ids of a metric name as they stand in row keys; ids that need more bytes stand in none."""
    unsigned = F.col("uid").cast("long").bitwiseAND(F.lit(2**32 - 1))
    return (
        uids.filter((F.col("qualifier") == "metrics") & (F.col("name") == metric))
        .filter(unsigned < 2 ** (8 * id_size))
        .select(F.unhex(F.lpad(F.hex(unsigned), 2 * id_size, "0")).alias("_metric_id"))
        .distinct()
    )


def _four_bytes(seconds: int) -> bytes:
    return min(max(seconds, 0), 2**32 - 1).to_bytes(TIME_BYTES, "big")


def _base_range(start: str | datetime, end: str | datetime) -> tuple[bytes, bytes]:
    """Base times, as they stand in row keys, of cells that can hold points of a time range."""
    return _four_bytes(math.floor(as_utc(start).timestamp()) - MAX_OFFSET), _four_bytes(math.floor(as_utc(end).timestamp()))


def _in_time(start: str | datetime, end: str | datetime, id_size: int) -> Column:
    first, last = _base_range(start, end)
    return has_key_shape(id_size) & base_time_bytes(id_size).between(F.lit(first), F.lit(last))


def prune_cells(
    cells: DataFrame,
    uids: DataFrame,
    metric: str,
    start: str | datetime,
    end: str | datetime,
    id_size: int = 4,
    salts: Iterable[int] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Cells that can hold points of ``metric`` between ``start`` and ``end``.

    A point lies at most ``MAX_OFFSET`` seconds after its cell's base time, so
    nothing that matches is lost. If the salt values in use are given, the same
    condition is also stated as one range of ``row_key`` per salt, from the least to the
    largest id, which a table sorted by row key answers from file statistics without
    reading the rest. The ids themselves are joined, and broadcast while their counted
    bytes allow it.
    """
    first, last = _base_range(start, end)
    kept = cells.filter(_in_time(start, end, id_size))
    ids = _stored_ids(uids, metric, id_size)
    count, least, largest = ids.agg(F.count("*"), F.min("_metric_id"), F.max("_metric_id")).first()
    if not count:
        return kept.filter(F.lit(False))
    if salts is not None:
        kept = kept.filter(reduce(or_, [_key_range(bytes([salt]), bytes(least), bytes(largest), first, last) for salt in salts]))
    if count * 64 <= broadcast_bytes:
        ids = F.broadcast(ids)
    return kept.join(ids, metric_id_bytes(id_size) == F.col("_metric_id"), "left_semi")


def _key_range(salt: bytes, least: bytes, largest: bytes, first: bytes, last: bytes) -> Column:
    """Row keys of a salt from the first time of the least id to any tags at the last time of the largest."""
    held = F.col("row_key") >= F.lit(salt + least + first)
    above = _after(salt + largest + last)
    return held if above is None else held & (F.col("row_key") < F.lit(above))


def find_files(
    cells: DataFrame,
    uids: DataFrame,
    metric: str,
    lsp_id: int,
    start: str | datetime,
    end: str | datetime,
    id_size: int = 4,
    *,
    prune: bool = False,
    salts: Iterable[int] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    compact_bytes: int = COMPACT_BYTES,
) -> DataFrame:
    """Distinct files with matching points.

    By default every cell is decoded and checked first, so a bad cell anywhere
    fails the search. ``prune`` reads and checks only cells that can match.
    """
    only = None
    if prune:
        cells = prune_cells(cells, uids, metric, start, end, id_size, salts, broadcast_bytes)
        only = (F.col("metric") == metric) & (F.col("lsp_id") == lsp_id)
    points = decode_points(
        cells, uids, id_size, only=only, provenance=True, broadcast_bytes=broadcast_bytes, compact_bytes=compact_bytes
    )
    return files_of(points.filter(point_filter(metric, lsp_id, start, end)))


def find_files_by_index(
    spark: SparkSession,
    index: str,
    metric: str,
    lsp_id: int,
    start: str | datetime,
    end: str | datetime,
    id_size: int = 4,
    *,
    format: str = "parquet",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Distinct files with matching points, of a cell table whose index (``write_index``) lies in a folder.

    Only files that can match are opened, and of those only cells that can are decoded and checked. Their
    names come from the index, so no dictionary is read. Files and series that came after the index are
    not seen. The paths of the files to open go through the driver, as in any listing.
    """
    series, bits = indexed_series(spark, index, metric, lsp_id, broadcast_bytes)
    files = [r["file"] for r in files_with(spark, index, bits, start, end).filter("may_match").collect()] if bits else []
    if not files:
        return spark.createDataFrame([], "file string")
    cells = read_cells(spark, files, format=format).filter(_in_time(start, end, id_size))
    decoded = raise_errors(decode_cells(cells, series, id_size, F.lit(True)))
    return files_of(explode_points(decoded, id_size, provenance=True).filter(point_filter(metric, lsp_id, start, end)))
