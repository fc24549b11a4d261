from datetime import datetime, timezone
from unittest.mock import MagicMock

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from vectors import R4, cells_of, row_key, uids_of

from packedts.operators.counts import count_points
from packedts.operators.decode import decode_points
from packedts.operators.dictionary import read_uids
from packedts.operators.series import series_keys
from packedts.operators.timeorder import minute_histogram, time_bounds
from packedts.plans.jobs import ConvertOptions, SearchOptions, convert, count, dedupe, search
from packedts.schemas import POINT_COLUMNS, POINTS
from packedts.scratch import scratch_path, scratch_tables
from packedts.sinks import points as sink
from packedts.sources.cells import read_cells, read_points

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    """Cells of three days and their dictionary, as tables."""
    base = tmp_path_factory.mktemp("archive")
    rows = []
    for hour in range(60):
        for metric in (1, 2):
            key = row_key((1, 1), (4, 4), metric=metric, base=f"{0x6066EB20 + 3600 * hour:08x}")
            rows.append((key, b"t", "0000 03c0 e0f0", "05 06 07 00", len(rows)))
    rows.append((row_key(), b"t", "050000", "f000 05", len(rows)))
    rows.append((R4, b"t", "010000", "7b7d", len(rows)))
    cells_of(spark, rows).drop("file").repartition(5).write.parquet(str(base / "cells"))
    uids = uids_of(spark, [(2, "metrics", "volts")])
    uids.select(
        F.col("name").cast("binary").alias("row_key"),
        F.lit(b"id").alias("family"),
        F.col("qualifier").cast("binary").alias("qualifier"),
        F.unhex(F.lpad(F.hex("uid"), 8, "0")).alias("value"),
        F.lit(1).cast("bigint").alias("version"),
    ).write.parquet(str(base / "uids"))
    return str(base / "cells"), str(base / "uids")


ROWS = 60 * 2 * 3 + 1


def unsorted_rows(table, *order):
    key = F.struct(*order)
    in_file = Window.partitionBy("file").orderBy("row")
    rows = table.withColumns({"file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")})
    return rows.withColumn("late", key < F.lag(key).over(in_file)).filter("late").count()


@pytest.mark.parametrize("options", [{}, {"exact_order": True}, {"fanout": True}, {"partitions": 3}])
def test_convert(spark, archive, tmp_path, options):
    target = str(tmp_path / "points")
    before = spark.conf.get(WRITERS)
    assert convert(spark, ConvertOptions(*archive, target, **options)) is None
    assert spark.conf.get(WRITERS) == before
    table = read_points(spark, target)
    assert table.columns == [*POINT_COLUMNS, "day"]
    assert table.count() == ROWS
    assert table.filter("day <> to_date(time)").count() == 0
    assert sorted(p.name for p in (tmp_path / "points").glob("day=*")) == [f"day=2021-04-0{d}" for d in (2, 3, 4)]
    if "fanout" not in options:
        assert unsorted_rows(table, "time") == 0


def test_all_ways_to_write_hold_the_same_rows(spark, archive, tmp_path):
    tables = []
    for name, options in {"a": {}, "b": {"exact_order": True}, "c": {"fanout": True}}.items():
        convert(spark, ConvertOptions(*archive, str(tmp_path / name), **options))
        tables.append(sorted(map(str, read_points(spark, str(tmp_path / name)).collect())))
    assert tables[0] == tables[1] == tables[2]


def test_convert_replaces(spark, archive, tmp_path):
    target = str(tmp_path / "points")
    for _ in range(2):
        convert(spark, ConvertOptions(*archive, target))
    assert read_points(spark, target).count() == ROWS


def test_convert_to_catalog_table(spark, archive):
    spark.sql("DROP TABLE IF EXISTS imported_points")
    convert(spark, ConvertOptions(*archive, "imported_points"))
    assert spark.table("imported_points").count() == ROWS
    assert "day" in [r.col_name for r in spark.sql("DESCRIBE imported_points").collect()]


def test_dry_run_counts_and_writes_nothing(spark, archive, tmp_path):
    target = tmp_path / "points"
    assert convert(spark, ConvertOptions(*archive, str(target), dry_run=True)) == ROWS
    assert not target.exists()


def test_dry_run_finds_bad_cells(spark, archive, tmp_path):
    cells_of(spark, [(R4, b"t", "0000", "05 00", 1)]).drop("file").write.parquet(str(tmp_path / "cells"))
    with pytest.raises(Exception, match="cannot decode a cell in file .*left over"):
        convert(spark, ConvertOptions(str(tmp_path / "cells"), archive[1], "unused/x", dry_run=True))


def ranges_of(spark, cells, uids, partitions):
    """Per partition: rows, first and last time; and the points in order of the version."""
    bounds = time_bounds(cells, partitions=partitions)
    assert (np.diff(bounds) >= 0).all() and len(bounds) < partitions
    points = decode_points(cells, uids, bounds=bounds)
    spans = points.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.min("time").alias("low"), F.max("time").alias("high"))
    return spans.orderBy("p").collect(), points


def plain(points):
    return sorted(map(str, points.collect()))


def test_ranges_of_time_are_disjoint_and_even(spark):
    """Cells of 600 points each, packed and append ones, are cut where ranges end."""
    rows = []
    for hour in range(12):
        q = b"".join(((6 * k) << 4).to_bytes(2, "big") for k in range(600))
        rows.append((row_key((1, 1), base=f"{0x6066EB20 + 3600 * hour:08x}"), b"t", q, bytes(k % 100 for k in range(600)) + b"\0", hour))
        v = b"".join(((6 * k) << 4).to_bytes(2, "big") + bytes([k % 100]) for k in range(600))
        rows.append((row_key((4, 4), base=f"{0x6066EB20 + 3600 * hour:08x}"), b"t", "050000", v, 100 + hour))
    cells, uids = cells_of(spark, rows), uids_of(spark)
    for partitions in (2, 5, 40):
        spans, points = ranges_of(spark, cells, uids, partitions)
        assert all(a.high < b.low for a, b in zip(spans, spans[1:]))
        assert len(spans) == partitions and max(r.n for r in spans) <= 2 * min(r.n for r in spans)
        assert plain(points) == plain(decode_points(cells, uids))


def test_crowded_second_is_shared(spark):
    """Points that share one second, of copies even of one series, do not end up in one task."""
    cells = cells_of(spark, [(R4, b"t", "0000", "05", n) for n in range(4000)]).repartition(8)
    spans, points = ranges_of(spark, cells, uids_of(spark), 4)
    assert len(spans) >= 3 and max(r.n for r in spans) < 2000 and points.count() == 4000


def test_points_out_of_order_in_their_cell(spark):
    rows = [(R4, b"t", "e0f0 0000 7080 0010", "01 02 03 04 00", 1), (R4, b"t", "050000", "f0f0 01 0000 02", 2)]
    cells, uids = cells_of(spark, rows), uids_of(spark)
    for bounds in ([], [0x6066EB20 + 2000], [0x6066EB20 + k for k in (1, 1, 1, 3000)]):
        assert plain(decode_points(cells, uids, bounds=np.array(bounds, np.int64))) == plain(decode_points(cells, uids))


def test_ranges_follow_the_size_of_the_input(spark, archive):
    assert len(time_bounds(read_cells(spark, archive[0]))) == 0
    many = cells_of(spark, [(row_key(base=f"{0x6066EB20 + 3600 * n:08x}"), b"t", bytes(2000), bytes(1001), n) for n in range(100)])
    assert len(time_bounds(many)) == min(spark.sparkContext.defaultParallelism, 5) - 1
    assert len(time_bounds(cells_of(spark, []))) == 0 and len(time_bounds(many, partitions=7)) == 6


def test_bounds_read_no_values(spark, archive):
    plan = minute_histogram(read_cells(spark, archive[0]))._jdf.queryExecution().executedPlan().toString()
    assert "value:binary" not in plan and "qualifier:binary" in plan


def test_convert_scans_values_once(spark, archive):
    cells = read_cells(spark, archive[0])
    points = decode_points(cells, read_uids(read_cells(spark, archive[1])), bounds=time_bounds(cells, partitions=4))
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert plan.count("value:binary") == 1 and "rangepartitioning" not in plan
    # pieces are shuffled, points are made behind the exchange
    assert plan.index("posexplode") < plan.index("Exchange")


@pytest.mark.parametrize("options", [{}, {"fanout": True}, {"exact_order": True}, {"compact_bytes": 0, "broadcast_bytes": 100}])
def test_bad_cells_are_set_aside(spark, archive, tmp_path, options):
    good = read_cells(spark, archive[0]).drop("file")
    bad = [(R4, b"t", "0000", "05 00", 900), (R4[:-1], b"t", "0000", "05", 901), (row_key((1, 99)), b"t", "0000", "05", 902), (R4, b"t", "00", "05", 903)]
    good.unionByName(cells_of(spark, bad).drop("file")).write.parquet(str(tmp_path / "cells"))
    target, errors = str(tmp_path / "points"), str(tmp_path / "errors")
    convert(spark, ConvertOptions(str(tmp_path / "cells"), archive[1], target, errors_to=errors, **options))
    convert(spark, ConvertOptions(*archive, str(tmp_path / "all")))
    columns = POINT_COLUMNS
    assert plain(read_points(spark, target).select(*columns)) == plain(read_points(spark, str(tmp_path / "all")).select(*columns))
    found = {r.version: r for r in spark.read.parquet(errors).collect()}
    assert {v: r.error for v, r in found.items()} == {
        900: "value bytes left over", 901: "row key of wrong length", 902: "unknown tag value id", 903: "odd qualifier length",
    }
    assert bytes(found[901].row_key) == R4[:-1] and all(str(tmp_path / "cells") in r.file for r in found.values())


def test_dry_runs_set_nothing_aside(spark, archive, tmp_path):
    with pytest.raises(ValueError, match="writes nothing"):
        convert(spark, ConvertOptions(*archive, "unused/x", dry_run=True, errors_to=str(tmp_path / "e")))


def test_search_job(spark, archive):
    options = SearchOptions(*archive, metric="power", lsp_id=2400, start="2021-04-02T10:50:00Z", end="2021-04-03T10:50:00Z")
    found = search(spark, options)
    pruned = search(spark, SearchOptions(**{**options.__dict__, "prune": True}))
    assert found.count() > 0
    assert sorted(found.collect()) == sorted(pruned.collect())


def test_count_job(spark, archive):
    assert count(spark, archive[0]) == ROWS - 1


def test_count_reads_qualifiers_only(spark, archive):
    plan = count_points(read_cells(spark, archive[0], tag_file=False))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<qualifier:binary>" in plan


def test_series_pass_reads_keys_only(spark, archive):
    plan = series_keys(read_cells(spark, archive[0]), 4)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<row_key:binary,family:binary" in plan and "value:binary" not in plan
    assert "EqualTo(family" in plan


def test_decode_moves_no_cells(spark, archive):
    points = decode_points(read_cells(spark, archive[0]), read_uids(read_cells(spark, archive[1])))
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1
    table = decode_points(read_cells(spark, archive[0]), read_uids(read_cells(spark, archive[1])), compact_bytes=0)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert plan.count("ArrowEvalPython") == 1


@pytest.fixture
def doubled(spark, archive, tmp_path):
    source = str(tmp_path / "points")
    convert(spark, ConvertOptions(*archive, source))
    points = read_points(spark, source)
    twice = str(tmp_path / "twice")
    sink.replace_points(points.unionAll(points.withColumn("tags", F.create_map(F.lit("a"), F.lit("b")))), twice)
    return twice


def test_dedupe_job(spark, doubled, tmp_path):
    target = str(tmp_path / "clean")
    plan = dedupe(spark, doubled, target, "2021-04-03T06:00:00Z", "2021-04-05T06:00:00Z", 1)
    assert plan.count() == 4
    table = read_points(spark, target)
    assert table.drop("day", "tags").distinct().count() == table.count() == ROWS
    assert unsorted_rows(table, "day", "metric", "lsp_id", "circuit_id", "time") == 0
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        dedupe(spark, doubled, target)


def test_append_without_adaptive_execution(spark, doubled, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sink.append_points(read_points(spark, doubled), str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    table = read_points(spark, str(tmp_path / "t"))
    assert table.count() == 2 * ROWS
    assert unsorted_rows(table, "day", "metric", "lsp_id", "circuit_id", "time") == 0


def test_dedupe_into_catalog_table(spark, doubled):
    spark.sql("DROP TABLE IF EXISTS clean_points")
    dedupe(spark, doubled, "clean_points", "2021-04-03", "2021-04-04", 1)
    assert spark.table("clean_points").count() == ROWS


def test_dedupe_drops_points_without_time(spark, tmp_path):
    row = ("power", datetime(2021, 4, 3, tzinfo=timezone.utc), 1.0, 1, 1, "p", {}, 1, 0)
    rows = [row, row, (row[0], None, *row[2:])]
    sink.replace_points(spark.createDataFrame(rows, POINTS), str(tmp_path / "in"))
    dedupe(spark, str(tmp_path / "in"), str(tmp_path / "out"), "2021-04-03", "2021-04-04", 1)
    assert read_points(spark, str(tmp_path / "out")).count() == 1


def test_dedupe_dry_run(spark, tmp_path):
    plan = dedupe(spark, "no/such", str(tmp_path / "clean"), dry_run=True)
    assert plan.count() == 66
    assert not (tmp_path / "clean").exists()


def test_day_transform_catalogs(spark, monkeypatch):
    """Tables of a v2 catalog are partitioned by days(time); only the calls can be checked here."""
    spark.conf.set("spark.sql.catalog.lake", "some.Catalog")
    try:
        assert sink.has_day_transform(spark, "lake.db.points")
        assert not sink.has_day_transform(spark, "db.points")
        assert not sink.has_day_transform(spark, "/lake/db/points")
        rows = MagicMock(sparkSession=spark)
        sink.replace_points(rows, "lake.db.points")
        sink.replace_points(rows, "lake.db.points", fanout=True)
        sink.append_points(rows, "lake.db.points")
    finally:
        spark.conf.unset("spark.sql.catalog.lake")
    chosen = rows.select.return_value
    chosen.orderBy.assert_called_once_with("time")
    chosen.orderBy.return_value.writeTo.assert_called_once_with("lake.db.points")
    chosen.writeTo.return_value.partitionedBy.return_value.option.assert_called_once_with("fanout-enabled", "true")
    chosen.writeTo.return_value.append.assert_called_once_with()


def test_scratch_follows_the_session(spark):
    assert scratch_path(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def _scratch(spark):
    from pathlib import Path

    root = Path(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    return {p.name for p in root.iterdir()} if root.exists() else set()


@pytest.mark.parametrize("options", [{}, {"compact_bytes": 0}, {"compact_bytes": 0, "broadcast_bytes": 0}, {"errors_to": "errors"}, {"dry_run": True}])
def test_jobs_leave_no_scratch_tables(spark, archive, tmp_path, options):
    before = _scratch(spark)
    if "errors_to" in options:
        options = {"errors_to": str(tmp_path / "errors")}
    convert(spark, ConvertOptions(*archive, str(tmp_path / "points"), **options))
    assert _scratch(spark) == before
    if not options.get("dry_run"):
        assert read_points(spark, str(tmp_path / "points")).count() == ROWS


def test_failed_jobs_leave_no_scratch_tables(spark, tmp_path):
    before = _scratch(spark)
    cells_of(spark, [(R4, b"t", "010000", "7b7d", 1), (row_key(), b"t", "00", "05", 2)]).drop("file").write.parquet(str(tmp_path / "cells"))
    uids_of(spark, []).select(
        F.col("name").cast("binary").alias("row_key"),
        F.lit(b"id").alias("family"),
        F.col("qualifier").cast("binary").alias("qualifier"),
        F.unhex(F.lpad(F.hex("uid"), 8, "0")).alias("value"),
        F.lit(1).cast("bigint").alias("version"),
    ).write.parquet(str(tmp_path / "uids"))
    with pytest.raises(Exception, match="odd qualifier length"):
        convert(spark, ConvertOptions(str(tmp_path / "cells"), str(tmp_path / "uids"), str(tmp_path / "points"), compact_bytes=0))
    assert _scratch(spark) == before


def test_scratch_tables_nest(spark):
    def table(name):
        path = scratch_path(spark, name)
        spark.range(3).write.parquet(path)
        return path.rsplit("/", 1)[1]

    with scratch_tables(spark):
        outer = table("outer")
        with scratch_tables(spark):
            inner = table("inner")
        assert outer in _scratch(spark) and inner not in _scratch(spark)
    kept = table("kept")
    assert outer not in _scratch(spark) and kept in _scratch(spark)
