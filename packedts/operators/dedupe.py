"""Exact-key deduplication, in one go or in time slices."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packedts.operators.instants import as_utc, instant, utc_day

# Rows that agree in all of these are copies. Tags do not count.
DEDUPE_KEYS = ("time", "metric", "lsp_id", "circuit_id", "power_sign", "value", "version", "idx")


def dedupe_points(points: DataFrame, tie_break: Sequence[Column] = ()) -> DataFrame:
    """One row of each group of copies.

    Nulls match nulls, NaN matches NaN and -0.0 matches 0.0. Which copy stays is
    left open unless ``tie_break`` orders them. Spark limits each group to one row
    before the shuffle as well as after it, so copies do not pile up in a task.
    """
    window = Window.partitionBy(*DEDUPE_KEYS).orderBy("time", *tie_break)
    return points.withColumn("_rownum", F.row_number().over(window)).filter("_rownum = 1").drop("_rownum")


@dataclass(frozen=True)
class Slice:
    """Half-open time range; an end may be open."""

    lower: datetime | None
    upper: datetime | None

    def predicate(self, time: Column | None = None, day: Column | None = None) -> Column:
        """Condition on ``time``, and on the partition column ``day`` if there is one."""
        time = F.col("time") if time is None else time
        held = time.isNotNull()
        if self.lower is not None:
            held = held & (time >= instant(self.lower))
            if day is not None:
                held = held & (day >= utc_day(instant(self.lower)))
        if self.upper is not None:
            held = held & (time < instant(self.upper))
            if day is not None:
                held = held & (day <= utc_day(instant(self.upper - timedelta(microseconds=1))))
        return held

    def __str__(self) -> str:
        parts = []
        if self.lower is not None:
            parts.append(f"time>='{self.lower:%Y-%m-%d %H:%M:%S}Z'")
        if self.upper is not None:
            parts.append(f"time<'{self.upper:%Y-%m-%d %H:%M:%S}Z'")
        return " and ".join(parts)


def plan_slices(first: str | datetime, last: str | datetime, step_days: int = 10) -> list[Slice]:
    """Everything before ``first``, steps until ``last`` is reached, everything after.

    The slices are disjoint and together hold every point that has a time.
    """
    if step_days < 1:
        raise ValueError(f"a slice is at least one day long, got {step_days}")
    begin, step = as_utc(first), timedelta(days=step_days)
    steps = max(0, math.ceil((as_utc(last) - begin) / step))
    edges = [None, *(begin + k * step for k in range(steps + 1)), None]
    return [Slice(lower, upper) for lower, upper in pairwise(edges)]


def slice_table(spark: SparkSession, slices: Sequence[Slice]) -> DataFrame:
    """The slice plan as rows, in order: what a dry run reports."""
    rows = [(number, s.lower, s.upper, str(s)) for number, s in enumerate(slices)]
    return spark.createDataFrame(rows, "slice int, lower timestamp, upper timestamp, predicate string")


def slice_number(time: Column, slices: Sequence[Slice]) -> Column:
    """Position of the slice a time falls into; NULL for no time."""
    first, last = slices[0].upper, slices[-1].lower
    inner = slices[1:-1]
    number = F.when(time < instant(first), 0).when(time >= instant(last), len(slices) - 1)
    if inner:
        step = int((inner[0].upper - inner[0].lower).total_seconds()) * 1_000_000
        past = F.unix_micros(time) - F.unix_micros(instant(first))
        number = number.otherwise(F.floor(past / step).cast("int") + 1)
    return number


def dedupe_slice(points: DataFrame, part: Slice, tie_break: Sequence[Column] = ()) -> DataFrame:
    """Deduplicated points of one slice.

    Time is one of the keys, so filtering first gives the same rows and lets the
    scan skip the partitions of other days.
    """
    day = F.col("day") if "day" in points.columns else None
    return dedupe_points(points.filter(part.predicate(day=day)), tie_break)
