"""A log of finished slices, by which a broken run goes on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packedts.operators.dedupe import Slice
from packedts.operators.instants import utc_day
from packedts.scratch import scratch_path
from packedts.sinks.points import append_points, overwrite_days
from packedts.sources.cells import read_points

STATES = "at long, slice int, predicate string, state string, rest string"
PLANNED, BEGUN, MENDING, DONE = "planned", "begun", "mending", "done"


class SliceLog:
    """States of the slices of one run, a small file each, in the order they were reached.

    A slice that was begun and not finished may have left rows, and a rerun must not add to them. So it is
    mended: the other rows of its days are set aside first, in the scratch folder, and then its days are
    overwritten with those and the slice. Mending may break as well and starts from what was set aside.
    """

    def __init__(self, spark: SparkSession, path: str, slices: Sequence[Slice]) -> None:
        self.spark, self.path = spark, path
        plan = {number: str(part) for number, part in enumerate(slices)}
        try:
            rows = spark.read.schema(STATES).json(path).orderBy("at").collect()
        except AnalysisException:  # no such folder yet
            rows = []
        self.last = {r["slice"]: r for r in rows if r["state"] != PLANNED}
        told = {r["slice"]: r["predicate"] for r in rows if r["state"] == PLANNED}
        if told and told != plan:
            raise ValueError(f"{path} tells of a run with other slices")
        self.continues = bool(told)
        self.at = rows[-1]["at"] if rows else 0
        if not told:
            self._tell([(0, number, predicate, PLANNED, None) for number, predicate in plan.items()])

    def _tell(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, STATES).coalesce(1).write.mode("append").json(self.path)

    def _reach(self, number: int, part: Slice, state: str, rest: str | None = None) -> None:
        self.at += 1
        self._tell([(self.at, number, str(part), state, rest)])

    def is_done(self, number: int) -> bool:
        return number in self.last and self.last[number]["state"] == DONE

    def begin(self, number: int, part: Slice) -> None:
        """Tell that rows of a slice may stand in the target from now on."""
        self._reach(number, part, BEGUN)

    def write(self, number: int, part: Slice, found: DataFrame, target: str) -> None:
        """Write the deduplicated points of a slice, once, whatever an earlier run left of it."""
        earlier = self.last.get(number)
        if earlier is None:
            self.begin(number, part)
            append_points(found, target)
        else:
            rest = earlier["rest"] if earlier["state"] == MENDING else self._set_aside(number, part, found, target)
            overwrite_days(found.unionByName(self.spark.read.parquet(rest), allowMissingColumns=True), target)
        self._reach(number, part, DONE)

    def _set_aside(self, number: int, part: Slice, found: DataFrame, target: str) -> str:
        """Store the rows that other slices have in the days of this one."""
        table = read_points(self.spark, target)
        days = found.select(utc_day(F.col("time")).alias("_day")).distinct()
        rest = scratch_path(self.spark, f"slice-{number}-rest")
        others = table.filter(~part.predicate()).withColumn("_day", utc_day(F.col("time")))
        others.join(days, "_day", "left_semi").drop("_day").write.parquet(rest)
        self._reach(number, part, MENDING, rest)
        return rest
