"""Cells to points."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packedts.functions.points import split_points, split_points_at
from packedts.operators.cellparts import (
    ANNOTATION,
    APPEND,
    INVALID,
    base_seconds,
    cell_kind,
    has_key_shape,
    is_point_family,
    series_key,
)
from packedts.operators.lookup import BROADCAST_BYTES
from packedts.operators.series import COMPACT_BYTES, NamesInTask, SeriesTable, names_for
from packedts.schemas import POINT_COLUMNS, SALT_BYTES
from packedts.scratch import scratch_path


# A series that turned up after the series table was built must not pass unnamed.
UNNAMED = "CASE WHEN metric IS NULL THEN 'series not seen before' END"


def decode_cells(
    cells: DataFrame,
    series: SeriesTable | NamesInTask,
    id_size: int = 4,
    only: Column | None = None,
    bounds: np.ndarray | None = None,
    strict: bool = False,
) -> DataFrame:
    """One row per point cell: names, ``split.points`` and the first ``error``.

    With ``bounds``, ascending seconds, points come as ``split.pieces``, parted there. ``strict``
    fails on cells without a proper key or qualifier before any names are looked up.
    """
    cells = (
        cells.filter(is_point_family())
        .withColumn("kind", cell_kind())
        .filter(F.col("kind") != ANNOTATION)
        .withColumns(
            {
                "_shape_error": F.when(F.col("kind") == INVALID, "odd qualifier length").when(
                    ~has_key_shape(id_size), "row key of wrong length"
                ),
                # cells without a proper key have no names to look up
                "series_key": F.when(has_key_shape(id_size), series_key(id_size)),
            }
        )
    )
    proper = F.col("_shape_error").isNull()
    if only is not None:
        cells = series.where(only).attach(cells.filter(proper), "inner")
    elif strict:
        cells = series.attach(raise_errors(cells, "_shape_error"))
    else:
        cells = series.attach(cells)
    bytes_ = F.col("qualifier"), F.col("value"), F.col("kind") == APPEND
    if bounds is None:
        split = split_points(*bytes_)
    else:
        # improper keys have no base time; their error comes first
        base = F.when(proper, base_seconds(id_size)).otherwise(0)
        split = split_points_at(*bytes_, base, F.shiftrightunsigned(F.xxhash64("row_key", "version"), 1), bounds)
    return cells.withColumn("split", split).withColumn(
        "error", F.expr(f"coalesce(_shape_error, series_error, {UNNAMED}, split.error)")
    )


def raise_errors(cells: DataFrame, error: str = "error") -> DataFrame:
    """Stop the job at the first cell that cannot be decoded, naming its file."""
    # A filter, not a column: column pruning would drop it under count().
    return cells.filter(
        F.expr(
            f"""CASE WHEN {error} IS NULL THEN true ELSE cast(raise_error(
                    concat('cannot decode a cell in file ', coalesce(file, '(unknown)'), ': ', {error})) AS boolean) END"""
        )
    )


def with_file(cells: DataFrame) -> DataFrame:
    return cells if "file" in cells.columns else cells.withColumn("file", F.lit(None).cast("string"))


# Whatever is the same for all points of a cell is worked out before they part.
PER_CELL = ["metric", "lsp_id", "circuit_id", "power_sign", "tags", "version", "file"]


def _per_cell(decoded: DataFrame, id_size: int, *split: Column) -> DataFrame:
    salt = F.substring("row_key", 1, SALT_BYTES).alias("salt")
    return decoded.select(*PER_CELL, salt, base_seconds(id_size).alias("_base"), *split)


def explode_points(decoded: DataFrame, id_size: int = 4, provenance: bool = False) -> DataFrame:
    """One row per point of decoded cells."""
    cells = _per_cell(decoded, id_size, F.col("split.points").alias("_points"))
    points = cells.select(*PER_CELL, "salt", "_base", F.posexplode("_points").alias("idx", "_point"))
    columns = {"time": "timestamp_seconds(_base + _point.offset) AS time", "value": "_point.value AS value"}
    return points.selectExpr(
        *[columns.get(column, column) for column in POINT_COLUMNS], *(["file", "salt"] if provenance else [])
    )


def explode_pieces(cells: DataFrame, ranges: int, provenance: bool = False) -> DataFrame:
    """One row per point of cells that are decoded in pieces, partitioned by time range.

    Pieces are shuffled, not points: their offsets and values are 12 bytes a point, and names and
    tags move once per piece. A cell has one piece for each range it reaches into.
    """
    pieces = cells.select(*PER_CELL, "salt", "_base", F.inline("_pieces"))
    if ranges > 1:
        pieces = pieces.repartitionById(ranges, "target")
    points = pieces.select(*PER_CELL, "salt", "_base", "first", F.posexplode(F.arrays_zip("offsets", "values")).alias("_place", "_point"))
    columns = {
        "time": "timestamp_seconds(_base + _point.offsets) AS time",
        "value": "_point.values AS value",
        "idx": "first + _place AS idx",
    }
    return points.selectExpr(
        *[columns.get(column, column) for column in POINT_COLUMNS], *(["file", "salt"] if provenance else [])
    )


def decode_points(
    cells: DataFrame,
    uids: DataFrame,
    id_size: int = 4,
    *,
    only: Column | None = None,
    bounds: np.ndarray | None = None,
    provenance: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    compact_bytes: int = COMPACT_BYTES,
) -> DataFrame:
    """All points of the given cells as rows of the ``POINTS`` schema.

    Any cell that cannot be decoded fails the job. With ``only``, a predicate on
    ``metric, lsp_id, circuit_id, power_sign, tags``, cells of other series are
    dropped unread: neither decoded nor checked. With ``bounds``, ascending seconds, points come
    partitioned into the time ranges between them. ``provenance`` adds ``file`` and ``salt``. The dictionary is checked at once,
    and a series table built if one is needed; the points come lazily.
    """
    cells = with_file(cells)
    series = names_for(cells, uids, id_size, broadcast_bytes, compact_bytes)
    decoded = raise_errors(decode_cells(cells, series, id_size, only, bounds, strict=True))
    if bounds is None:
        return explode_points(decoded, id_size, provenance)
    return explode_pieces(_per_cell(decoded, id_size, F.col("split.pieces").alias("_pieces")), len(bounds) + 1, provenance)


def decode_apart(
    cells: DataFrame,
    uids: DataFrame,
    id_size: int = 4,
    *,
    bounds: np.ndarray | None = None,
    provenance: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    compact_bytes: int = COMPACT_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """All points of the good cells, and the bad cells (``file, row_key, version, error``).

    Cells are decoded once, at once: decoded pieces and errors are stored in the scratch folder, 12 bytes a
    point, and both results read their part of that.
    """
    spark = cells.sparkSession
    cells = with_file(cells)
    series = names_for(cells, uids, id_size, broadcast_bytes, compact_bytes)
    ranges = 1 if bounds is None else len(bounds) + 1
    decoded = decode_cells(cells, series, id_size, bounds=np.zeros(0, np.int64) if bounds is None else bounds)
    bad = F.col("error").isNotNull()
    pieces = F.when(~bad, F.col("split.pieces")).alias("_pieces")
    stage = scratch_path(spark, "decoded")
    staged = _per_cell(decoded, id_size, pieces, F.when(bad, F.col("row_key")).alias("row_key"), "error", bad.alias("bad"))
    staged.write.partitionBy("bad").parquet(stage)
    stored = spark.read.schema(staged.schema).parquet(stage)
    errors = stored.filter("bad").select("file", "row_key", "version", "error")
    return explode_pieces(stored.filter("NOT bad"), ranges, provenance), errors


def decode_errors(
    cells: DataFrame,
    uids: DataFrame,
    id_size: int = 4,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    compact_bytes: int = COMPACT_BYTES,
) -> DataFrame:
    """The cells that cannot be decoded: ``file, row_key, version, error``."""
    cells = with_file(cells)
    series = names_for(cells, uids, id_size, broadcast_bytes, compact_bytes)
    return (
        decode_cells(cells, series, id_size)
        .filter(F.col("error").isNotNull())
        .select("file", "row_key", "version", "error")
    )
