"""Counting points and profiling their times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packedts.functions.points import header_of, split_points
from packedts.operators.cellparts import ANNOTATION, APPEND, INVALID, base_seconds, cell_kind, has_key_shape, is_point_family
from packedts.operators.decode import raise_errors, with_file
from packedts.schemas import APPEND_QUALIFIER, MAX_PACKED_OFFSET


def _points_by_qualifier():
    """Points a cell announces in its qualifier.

    Reads no other column. Qualifiers of 3 and 5 bytes count as none, which
    leaves out append cells as well as annotations.
    """
    length = F.octet_length("qualifier")
    return F.when(length.isin(3, 5), 0).otherwise(F.floor(length / 2))


def count_points_by_file(cells: DataFrame) -> DataFrame:
    return cells.groupBy("file").agg(F.sum(_points_by_qualifier()).alias("points"))


def count_points(cells: DataFrame) -> DataFrame:
    """One row: points announced over all cells, 0 if there are none."""
    return cells.agg(F.coalesce(F.sum(_points_by_qualifier()), F.lit(0)).alias("points"))


def row_count(points: DataFrame) -> DataFrame:
    """One row: number of decoded points, after decoding and checking them all."""
    return points.agg(F.count("*").alias("points"))


def time_range(points: DataFrame) -> DataFrame:
    """One row: first and last point time."""
    return points.agg(F.min("time").alias("min_time"), F.max("time").alias("max_time"))


def header_profile(cells: DataFrame, id_size: int = 4) -> DataFrame:
    """One row: points, first and last point time, without reading the values of packed cells.

    A packed cell tells its points' times in the qualifier; only append cells, found by theirs, are
    read whole. Headers are checked, and append cells; values of packed cells and ids are not.
    """
    cells = with_file(cells).filter(is_point_family())
    shape = F.when(cell_kind() == INVALID, "odd qualifier length").when(~has_key_shape(id_size), "row key of wrong length")
    packed = (
        cells.select("row_key", "family", "qualifier", "file")
        .filter(~cell_kind().isin(ANNOTATION, APPEND))
        .withColumn("h", header_of(F.col("qualifier")))
        .withColumn("error", F.coalesce(shape, F.when(F.col("h.last") > MAX_PACKED_OFFSET, "offset over one hour")))
    )
    append = (
        cells.filter(F.col("qualifier") == F.lit(APPEND_QUALIFIER))
        .withColumn("split", split_points(F.col("qualifier"), F.col("value"), F.lit(True)))
        .withColumn("error", F.coalesce(shape, F.col("split.error")))
        .withColumn("_offsets", F.col("split.points.offset"))
        .withColumn("h", F.struct(F.size("_offsets").alias("points"), F.array_min("_offsets").alias("first"), F.array_max("_offsets").alias("last")))
    )
    base = base_seconds(id_size)
    headers = [
        raise_errors(kind).select("h.points", (base + F.col("h.first")).alias("first"), (base + F.col("h.last")).alias("last"))
        for kind in (packed, append)
    ]
    return headers[0].unionByName(headers[1]).agg(
        F.coalesce(F.sum("points"), F.lit(0)).alias("points"),
        F.timestamp_seconds(F.min("first")).alias("min_time"),
        F.timestamp_seconds(F.max("last")).alias("max_time"),
    )
