"""Day-partitioned point tables."""

from __future__ import annotations

import threading
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packedts.operators.instants import utc_day
from packedts.schemas import POINT_COLUMNS, POINTS

IMPORT_ORDER = ("time",)
DEDUPE_ORDER = ("metric", "lsp_id", "circuit_id", "time")
# As many open files as there are days: a fanout write never falls back to sorting.
FANOUT_WRITERS = 2**31 - 1

_one_fanout = threading.Lock()
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def is_path(table: str) -> bool:
    return "/" in table


def has_day_transform(spark: SparkSession, table: str) -> bool:
    """Whether the table's catalog is a v2 one that can partition by ``days(time)``."""
    if is_path(table):
        return False
    parts = table.split(".")
    catalog = parts[0] if len(parts) > 2 or _is_catalog(spark, parts[0]) else spark.catalog.currentCatalog()
    return catalog != "spark_catalog" and _is_catalog(spark, catalog)


def _is_catalog(spark: SparkSession, name: str) -> bool:
    return spark.conf.get(f"spark.sql.catalog.{name}", None) is not None


def with_day(points: DataFrame) -> DataFrame:
    """The nine point columns and the UTC ``day`` they are partitioned by."""
    return points.select(*POINT_COLUMNS).withColumn("day", utc_day(F.col("time")))


def sorted_in_partitions(points: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows sorted by day and ``order``; the rest of the key only breaks ties,
    which puts like values side by side and keeps files small."""
    keys = ["day", *order]
    ties = [column for column in (*DEDUPE_ORDER, "version", "idx") if column not in order]
    return points.sortWithinPartitions(*keys, *ties)


def ranged(points: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned by day and ``order``, so that files hold disjoint ranges.

    The input partition takes part as a last key: equal keys, however many, can so
    be spread over several tasks.
    """
    sizes = () if partitions is None else (partitions,)
    spread = points.withColumn("_spread", F.spark_partition_id())
    return spread.repartitionByRange(*sizes, "day", *order, "_spread").drop("_spread")


@contextmanager
def _many_open_files(spark: SparkSession):
    """Spark has this as a session setting only; the lock keeps fanout writes of a driver apart."""
    with _one_fanout:
        before = spark.conf.get(_WRITERS)
        spark.conf.set(_WRITERS, FANOUT_WRITERS)
        try:
            yield
        finally:
            spark.conf.set(_WRITERS, before)


def _save(rows: DataFrame, table: str, mode: str) -> None:
    writer = rows.write.partitionBy("day").mode(mode).format("parquet")
    # Replacing means the whole table, whatever the session says.
    writer = writer.option("partitionOverwriteMode", "static")
    writer.save(table) if is_path(table) else writer.saveAsTable(table)


def replace_points(
    points: DataFrame,
    table: str,
    *,
    fanout: bool = False,
    arranged: bool = False,
    partitions: int | None = None,
) -> None:
    """Create or replace a table of points, partitioned by day and sorted by time.

    ``fanout`` writes the rows as they come, with one open file per day and task:
    no shuffle and no sort, for more memory and more files. ``arranged`` says that
    the points come from cells partitioned by base time, so that sorting inside
    each partition is all that is left to do.
    """
    spark = points.sparkSession
    if has_day_transform(spark, table):
        rows = points.select(*POINT_COLUMNS)
        if not fanout:
            rows = rows.sortWithinPartitions(*IMPORT_ORDER) if arranged else rows.orderBy(*IMPORT_ORDER)
        writer = rows.writeTo(table).partitionedBy(F.partitioning.days("time"))
        (writer.option("fanout-enabled", "true") if fanout else writer).createOrReplace()
    elif fanout:
        with _many_open_files(spark):
            _save(with_day(points), table, "overwrite")
    else:
        rows = with_day(points) if arranged else ranged(with_day(points), IMPORT_ORDER, partitions)
        _save(sorted_in_partitions(rows, IMPORT_ORDER), table, "overwrite")


def create_table(spark: SparkSession, table: str, if_missing: bool = False) -> None:
    """Create an empty day-partitioned point table; fails if it exists, or with ``if_missing`` leaves it."""
    if has_day_transform(spark, table):
        columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in POINTS)
        spark.sql(f"CREATE TABLE {'IF NOT EXISTS ' if if_missing else ''}{table} ({columns}) PARTITIONED BY (days(time))")
        spark.sql(f"ALTER TABLE {table} WRITE ORDERED BY {', '.join(DEDUPE_ORDER)}")
    else:
        _save(with_day(spark.createDataFrame([], POINTS)), table, "ignore" if if_missing else "errorifexists")


def append_points(points: DataFrame, table: str) -> None:
    """Append to a table made by ``create_table``, in its write order.

    Rows are gathered by day and metric, and adaptive execution evens out the
    partitions as they turn out: a metric with most of the rows is split, small
    ones share. Nothing upstream runs twice, as it would to sample ranges.
    """
    spark = points.sparkSession
    if has_day_transform(spark, table):
        points.select(*POINT_COLUMNS).writeTo(table).append()
        return
    rows = with_day(points)
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        rows = rows.hint("rebalance", "day", "metric")
    else:
        rows = ranged(rows, DEDUPE_ORDER)
    rows = sorted_in_partitions(rows, DEDUPE_ORDER)
    if is_path(table):
        _save(rows, table, "append")
    else:
        rows.write.insertInto(table)


def overwrite_days(points: DataFrame, table: str) -> None:
    """Replace the days that ``points`` hold, and no others, in the write order of ``append_points``."""
    spark = points.sparkSession
    if has_day_transform(spark, table):
        points.select(*POINT_COLUMNS).writeTo(table).overwritePartitions()
        return
    rows = sorted_in_partitions(with_day(points).hint("rebalance", "day", "metric"), DEDUPE_ORDER)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if is_path(table):
        writer.partitionBy("day").parquet(table)
    else:
        writer.insertInto(table)
