"""A side table for searches: what each file of a cell table can hold.

For each file the range of base times and a bitmap of hashed series keys, and a table of all
series with their names. A search reads these small tables first and then opens only the files that
can hold a match. A bitmap may say yes for a series that is not there, never no for one that is.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packedts.operators.cellparts import base_seconds, has_key_shape, is_point_family, series_key
from packedts.operators.dictionary import check_dictionary
from packedts.operators.instants import as_utc
from packedts.operators.lookup import BROADCAST_BYTES
from packedts.operators.series import ROW_BYTES, SeriesTable, name_series, series_keys
from packedts.schemas import MAX_OFFSET

# Bits of a file's bitmap: what Spark's bitmap aggregate holds.
BITS = 32768


def _bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def file_index(cells: DataFrame, id_size: int = 4) -> DataFrame:
    """``file, cells, first_base, last_base, series_bits`` of every file that holds cells of points."""
    return (
        cells.filter(is_point_family() & has_key_shape(id_size))
        .select("file", base_seconds(id_size).alias("base"), _bit(series_key(id_size)).alias("bit"))
        .groupBy("file")
        .agg(
            F.count("*").alias("cells"),
            F.min("base").alias("first_base"),
            F.max("base").alias("last_base"),
            F.bitmap_construct_agg("bit").alias("series_bits"),
        )
    )


def write_index(cells: DataFrame, uids: DataFrame, path: str, id_size: int = 4, limit: int = BROADCAST_BYTES) -> None:
    """Write the index of a cell table to a folder: row keys and families are read, once for each of its two tables."""
    file_index(cells, id_size).write.mode("overwrite").parquet(f"{path}/files")
    series = name_series(series_keys(cells, id_size), uids, id_size, check_dictionary(uids), limit)
    series.withColumn("_size", F.expr(ROW_BYTES)).write.mode("overwrite").parquet(f"{path}/series")


def indexed_series(
    spark: SparkSession, path: str, metric: str, lsp_id: int, limit: int = BROADCAST_BYTES
) -> tuple[SeriesTable, list[int]]:
    """The indexed series of a metric and device with their names, and the bits that stand for them.

    At most BITS numbers come to the driver, however many series match.
    """
    rows = spark.read.parquet(f"{path}/series").filter((F.col("metric") == metric) & (F.col("lsp_id") == lsp_id))
    found = rows.agg(F.collect_set(_bit(F.col("series_key"))).alias("bits"), F.coalesce(F.sum("_size"), F.lit(0)).alias("bytes")).first()
    return SeriesTable(rows, found["bytes"], limit), sorted(found["bits"])


def files_with(spark: SparkSession, path: str, bits: list[int], start: str | datetime, end: str | datetime) -> DataFrame:
    """``file, may_match``: every indexed file, and whether it can hold points of series with such bits in a time range."""
    first, last = int(as_utc(start).timestamp()) - MAX_OFFSET, int(as_utc(end).timestamp())
    in_time = (F.col("last_base") >= first) & (F.col("first_base") <= last)
    wanted = F.array(*(F.lit(b) for b in bits)) if bits else F.expr("cast(array() as array<int>)")
    byte = "cast(conv(hex(substring(series_bits, cast(b div 8 as int) + 1, 1)), 16, 10) as int)"
    held = F.expr(f"exists(_wanted, b -> (shiftright({byte}, cast(b % 8 as int)) & 1) = 1)")
    files = spark.read.parquet(f"{path}/files").withColumn("_wanted", wanted)
    return files.select("file", (in_time & held).alias("may_match"))


def candidate_files(
    spark: SparkSession, path: str, metric: str, lsp_id: int, start: str | datetime, end: str | datetime
) -> DataFrame:
    """``file, may_match``: every indexed file, and whether it can hold points of a metric and device in a time range."""
    return files_with(spark, path, indexed_series(spark, path, metric, lsp_id)[1], start, end)
