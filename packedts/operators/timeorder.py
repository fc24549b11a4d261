"""Ranges of time that hold about as many points each, for tables in one global time order."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packedts.functions.points import minute_counts, second_counts
from packedts.operators.cellparts import ANNOTATION, APPEND, INVALID, base_seconds, cell_kind, has_key_shape, is_point_family
from packedts.scratch import scratch_path

# Points that a task sorts and writes, and the least that are worth a task of their own.
TASK_POINTS, LEAST_POINTS = 2_000_000, 20_000
# Points an append cell is taken to hold where no packed cell tells.
APPEND_POINTS = 60


def _headers(cells: DataFrame, id_size: int) -> DataFrame:
    """Base second, qualifier and kind of the cells that hold points; no values."""
    return (
        cells.select("row_key", "family", "qualifier")
        .filter(is_point_family() & has_key_shape(id_size))
        .filter(~cell_kind().isin(ANNOTATION, INVALID))
        .select(base_seconds(id_size).alias("base"), "qualifier", (cell_kind() == APPEND).alias("is_append"))
    )


def minute_histogram(cells: DataFrame, id_size: int = 4) -> DataFrame:
    """``minute, points, appends``: points of packed cells, and the append cells that may have points then.

    Reads row keys, families and qualifiers; a qualifier holds the times of all points of a
    packed cell. Only append cells keep theirs in the value, which is not read.
    """
    return minute_counts(_headers(cells, id_size)).groupBy("minute").agg(F.sum("points").alias("points"), F.sum("appends").alias("appends"))


def time_bounds(cells: DataFrame, id_size: int = 4, partitions: int | None = None) -> np.ndarray:
    """Ascending seconds that part the points of ``cells`` into ranges of about equal size.

    Weighted quantiles of the minute histogram; inside a minute in proportion, or, where a minute
    is worth several ranges, by a second look at its seconds. A second that is worth several ranges stands
    in as many bounds. The number of ranges follows from the points unless it is given. The histogram is
    stored; an archive has at most 1.2 million hours, whose sums make one window, and minutes are looked at
    only in hours that hold a bound, so rows come to the driver by the number of ranges.
    """
    spark = cells.sparkSession
    path = scratch_path(spark, "minutes")
    minute_histogram(cells, id_size).write.parquet(path)
    minutes = spark.read.parquet(path)
    sums = minutes.agg(F.sum("points").alias("points"), F.sum("appends").alias("appends"), F.count("*").alias("minutes")).first()
    points, appends = sums["points"] or 0, (sums["appends"] or 0) / 60
    # An append cell is taken to hold what a minute of packed points does on average, for an hour.
    each = max(1, round(points / sums["minutes"])) * 60 if points and appends else APPEND_POINTS
    if partitions is None:
        estimate = points + appends * each
        fewest = min(spark.sparkContext.defaultParallelism, math.ceil(estimate / LEAST_POINTS))
        partitions = max(1, fewest, math.ceil(estimate / TASK_POINTS))
    weighed = minutes.select("minute", (60 * F.col("points") + each * F.col("appends")).alias("weight"))
    total = weighed.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    if not total or partitions < 2:
        return np.zeros(0, np.int64)

    def passed(weight: str) -> str:
        """How many bounds lie at or before a running weight."""
        return f"cast(cast({weight} as decimal(38, 0)) * {partitions} div {total} as int)"

    hours = (
        weighed.groupBy(F.expr("minute div 60").alias("hour"))
        .agg(F.sum("weight").alias("in_hour"))
        .selectExpr("hour", "in_hour", "sum(in_hour) OVER (ORDER BY hour) - in_hour AS before")
        .where(f"{passed('before + in_hour')} > {passed('before')}")
    )
    holding = (
        weighed.withColumn("hour", F.expr("minute div 60"))
        .join(F.broadcast(hours), "hour")
        .selectExpr("minute", "weight", "before + sum(weight) OVER (PARTITION BY hour ORDER BY minute) - weight AS before")
        .selectExpr("minute", "weight", "before", f"{passed('before')} + 1 AS first", f"least({partitions - 1}, {passed('before + weight')}) AS last")
        .where("first <= last")
        .collect()
    )
    places = {r["minute"]: [(k * total / partitions - r["before"]) / r["weight"] for k in range(r["first"], r["last"] + 1)] for r in holding}
    crowded = np.array(sorted(minute for minute, places_ in places.items() if len(places_) > 1), np.int64)
    running = _running_seconds(cells, id_size, crowded, each) if len(crowded) else {}
    bounds = []
    for minute, places_ in places.items():
        # at which of its seconds each share of the minute's points is passed
        seconds = np.searchsorted(running[minute], places_) if minute in running else np.multiply(places_, 60)
        bounds.append(minute * 60 + np.minimum(59, np.asarray(seconds, np.int64)))
    return np.sort(np.concatenate([np.zeros(0, np.int64), *bounds]))


def _running_seconds(cells: DataFrame, id_size: int, minutes: np.ndarray, each: int) -> dict[int, np.ndarray]:
    """The share of each minute's points up to each of its 60 seconds."""
    first, last = (int(m) * 60 for m in (minutes[0] - 60, minutes[-1] + 1))
    near = _headers(cells, id_size).filter(F.col("base").between(first - 4096, last))
    counts = second_counts(near, minutes).groupBy("second").agg(F.sum("points").alias("points"), F.sum("appends").alias("appends"))
    weights = np.zeros((len(minutes), 60))
    for r in counts.collect():
        weights[np.searchsorted(minutes, r["second"] // 60), r["second"] % 60] = 3600 * r["points"] + each * r["appends"]
    running = np.cumsum(weights, axis=1)
    return dict(zip(minutes.tolist(), running / running[:, -1:]))
