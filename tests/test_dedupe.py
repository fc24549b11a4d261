import math
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from packedts.operators.dedupe import (
    dedupe_points,
    dedupe_slice,
    plan_slices,
    slice_number,
    slice_table,
)
from packedts.schemas import POINTS

DAY = datetime(2021, 3, 5, 12, tzinfo=timezone.utc)
POINT = ("power", DAY, 1.5, 2400, 7, "p", {"site": "hq"}, 11, 0)
COLUMNS = POINTS.fieldNames()


def point(**changes):
    return tuple(changes.get(name, value) for name, value in zip(COLUMNS, POINT))


def points_of(spark, rows):
    return spark.createDataFrame(rows, POINTS)


def test_exact_copies_and_tags(spark):
    rows = [point(), point(), point(tags={"site": "other"}), point(tags={})]
    assert dedupe_points(points_of(spark, rows)).count() == 1


@pytest.mark.parametrize("change", [{"version": 12}, {"idx": 1}, {"value": 2.5}, {"metric": "volts"}, {"lsp_id": 1}, {"circuit_id": None}, {"power_sign": None}, {"time": DAY.replace(second=1)}])
def test_any_other_difference_keeps_both(spark, change):
    assert dedupe_points(points_of(spark, [point(), point(**change)])).count() == 2


@pytest.mark.parametrize("change", [{"lsp_id": None}, {"circuit_id": None}, {"power_sign": None}, {"value": float("nan")}, {"time": None}])
def test_nulls_and_nans_match(spark, change):
    assert dedupe_points(points_of(spark, [point(**change)] * 3)).count() == 1


def test_negative_zero(spark):
    kept = dedupe_points(points_of(spark, [point(value=-0.0)] * 2)).collect()
    assert [math.copysign(1, r.value) for r in kept] == [-1]
    assert dedupe_points(points_of(spark, [point(value=-0.0), point(value=0.0)])).count() == 1


def test_tie_break_decides(spark):
    rows = [point(tags={"n": str(n)}) for n in (3, 1, 2)]
    kept = dedupe_points(points_of(spark, rows), [F.col("tags")["n"]]).first()
    assert kept.tags == {"n": "1"}


def test_dedupe_twice_changes_nothing(spark):
    rows = [point(version=n % 3, value=float(n % 2)) for n in range(20)]
    once = dedupe_points(points_of(spark, rows))
    assert sorted(map(str, dedupe_points(once).collect())) == sorted(map(str, once.collect()))


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = dedupe_points(points_of(spark, [point()]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_default_plan_has_66_slices():
    slices = plan_slices("2021-03-01T00:00:00Z", "2022-12-01T00:00:00Z")
    assert len(slices) == 66
    assert str(slices[0]) == "time<'2021-03-01 00:00:00Z'"
    assert str(slices[1]) == "time>='2021-03-01 00:00:00Z' and time<'2021-03-11 00:00:00Z'"
    assert str(slices[-1]) == "time>='2022-12-01 00:00:00Z'"


def test_last_step_may_pass_the_end():
    slices = plan_slices("2021-03-01", "2021-03-12", 10)
    assert [str(s) for s in slices][-2:] == [
        "time>='2021-03-11 00:00:00Z' and time<'2021-03-21 00:00:00Z'",
        "time>='2021-03-21 00:00:00Z'",
    ]


def test_empty_range_leaves_two_open_slices():
    assert len(plan_slices("2021-03-01", "2021-03-01")) == 2


def test_step_must_advance():
    with pytest.raises(ValueError, match="at least one day"):
        plan_slices("2021-03-01", "2021-03-12", 0)


EDGES = ["2021-02-28T23:59:59", "2021-03-01T00:00:00", "2021-03-11T00:00:00", "2022-11-30T23:59:59", "2022-12-01T00:00:00"]


def test_slices_hold_every_time_once(spark):
    slices = plan_slices("2021-03-01", "2022-12-01")
    rows = [point(time=datetime.fromisoformat(e).replace(tzinfo=timezone.utc), version=i) for i, e in enumerate(EDGES)]
    points = points_of(spark, [*rows, point(time=None)])
    numbers = {r.version: r.n for r in points.select("version", slice_number(F.col("time"), slices).alias("n")).collect()}
    assert numbers == {0: 0, 1: 1, 2: 2, 3: 64, 4: 65, 11: None}
    for number in (0, 1, 2, 64, 65):
        assert [r.version for r in dedupe_slice(points, slices[number]).collect()] == [
            version for version, n in numbers.items() if n == number
        ]


def test_slices_together_equal_one_go(spark):
    slices = plan_slices("2021-03-04", "2021-03-07", 1)
    rows = [point(time=DAY.replace(day=1 + n % 9, hour=n % 7), version=n % 4) for n in range(120)]
    points = points_of(spark, rows).withColumn("day", F.to_date("time"))
    parts = [r for s in slices for r in dedupe_slice(points, s).collect()]
    assert sorted(map(str, parts)) == sorted(map(str, dedupe_points(points).collect()))


def test_slice_predicate_skips_partitions(spark, tmp_path):
    rows = [point(time=DAY.replace(day=d)) for d in range(1, 20)]
    points_of(spark, rows).withColumn("day", F.to_date("time")).write.partitionBy("day").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plan = dedupe_slice(table, plan_slices("2021-03-05", "2021-03-07", 1)[1])._jdf.queryExecution().executedPlan().toString()
    line = next(text for text in plan.splitlines() if "FileScan" in text)
    assert "day" in line.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(time" in line.split("PushedFilters: [")[1]


def test_plan_as_rows(spark):
    plan = slice_table(spark, plan_slices("2021-03-01", "2022-12-01")).orderBy("slice").collect()
    assert len(plan) == 66 and plan[0].lower is None and plan[-1].upper is None
    assert plan[1].predicate == "time>='2021-03-01 00:00:00Z' and time<'2021-03-11 00:00:00Z'"


def test_a_third_of_all_rows_are_one_point(spark):
    rows = spark.range(30_000).selectExpr(
        "'power' AS metric",
        "timestamp_seconds(1617357600 + if(id % 3 = 0, 0, id)) AS time",
        "1.5D AS value",
        "1 AS lsp_id",
        "2 AS circuit_id",
        "'p' AS power_sign",
        "map('n', cast(id AS string)) AS tags",
        "if(id % 3 = 0, 0L, id) AS version",
        "0 AS idx",
    )
    assert dedupe_points(rows).count() == 20_001
