"""The search index, the profile by headers, and the log of slices."""

import pytest
from pyspark.sql import functions as F
from test_decode import GOOD
from test_jobs import ROWS, archive, doubled  # noqa: F401
from vectors import R4, cells_of, row_key, uids_of

from packedts.operators.counts import header_profile, time_range
from packedts.operators.decode import decode_points
from packedts.operators.dedupe import dedupe_slice, plan_slices
from packedts.operators.dictionary import check_dictionary, dictionary_faults, long_ids, read_uids
from packedts.operators.fileindex import candidate_files, file_index, write_index
from packedts.operators.search import find_files, find_files_by_index
from packedts.plans.jobs import dedupe
from packedts.plans.slicelog import SliceLog
from packedts.sinks.points import append_points, create_table
from packedts.sources.cells import read_cells, read_points

FILES, HOURS = 24, 4


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """A file for each of 24 series and stretches of four hours: files are sorted by series and time."""
    rows = []
    for n in range(FILES * HOURS):
        key = row_key((1, 1), (4, 100 + n // HOURS % 6), base=f"{0x6066EB20 + 3600 * n:08x}")
        rows.append((n // HOURS, key, n))
    cells = spark.createDataFrame(rows, "f int, row_key binary, version long").select(
        "f", "row_key", F.lit(b"t").alias("family"), F.lit(b"\x00\x00").alias("qualifier"), F.lit(b"\x05").alias("value"), "version"
    )
    base = tmp_path_factory.mktemp("files")
    cells.write.partitionBy("f").parquet(str(base / "cells"))
    uids = uids_of(spark, [(100 + i, "tagv", f"site-{i}") for i in range(6)] + [(2, "metrics", "other")]).cache()
    write_index(read_cells(spark, str(base / "cells")), uids, str(base / "index"))
    return str(base / "cells"), uids, str(base / "index")


START, END = "2021-04-02T18:00:00Z", "2021-04-03T01:30:00Z"


def opened(spark, index, *search):
    return candidate_files(spark, index, *search).filter("may_match").count()


def test_index_names_every_file_once(spark, many_files):
    path, _, index = many_files
    files = spark.read.parquet(f"{index}/files").collect()
    assert len(files) == FILES and all(r.cells == HOURS and r.last_base - r.first_base == 3600 * (HOURS - 1) for r in files)
    assert all(len(r.series_bits) == 4096 and sum(bin(b).count("1") for b in r.series_bits) == 1 for r in files)


def test_search_by_index_opens_few_files(spark, many_files):
    path, uids, index = many_files
    plain = find_files(read_cells(spark, path), uids, "power", 2400, START, END).collect()
    found = find_files_by_index(spark, index, "power", 2400, START, END).collect()
    assert sorted(found) == sorted(plain) and found
    shuffled = find_files_by_index(spark, index, "power", 2400, START, END, broadcast_bytes=0)
    assert sorted(shuffled.collect()) == sorted(plain)
    assert opened(spark, index, "power", 2400, START, END) <= len(found) + 1 < FILES
    assert opened(spark, index, "power", 2401, START, END) == opened(spark, index, "other", 2400, START, END) == 0
    assert find_files_by_index(spark, index, "other", 2400, START, END).collect() == []
    assert opened(spark, index, "power", 2400, "2031-01-01", "2031-01-02") == 0


def test_index_tells_series_apart(spark):
    """Files of other series of a metric are not opened."""
    rows = {f"f{i}": cells_of(spark, [(row_key((1, t), metric=m), b"t", "0000", "05", i)], f"f{i}") for i, (m, t) in enumerate([(1, 1), (1, 2), (2, 1)])}
    files = {r.file: r for r in rows["f0"].unionByName(rows["f1"]).unionByName(rows["f2"]).transform(file_index).collect()}
    assert len({bytes(r.series_bits) for r in files.values()}) == 3


def test_indexing_reads_no_values(spark, many_files):
    plan = file_index(read_cells(spark, many_files[0]))._jdf.queryExecution().executedPlan().toString()
    assert "value:binary" not in plan and "qualifier:binary" not in plan


def good_cells(spark):
    return cells_of(spark, [(R4, b"t", q, v, i) for i, (q, v, _) in enumerate(GOOD.values())] + [(R4, b"t", "010000", "7b7d", 99), (R4, b"m", "00", "", 98)])


def test_profile_by_headers(spark):
    cells = good_cells(spark)
    points = decode_points(cells, uids_of(spark))
    row = header_profile(cells).first()
    assert (row.min_time, row.max_time) == tuple(time_range(points).first()) and row.points == points.count()
    assert tuple(header_profile(cells_of(spark, [])).first()) == (0, None, None)


@pytest.mark.parametrize("cell, message", [((R4[:-1], b"t", "0000", "05", 1), "wrong length"), ((R4, b"t", "00", "05", 1), "odd qualifier"), ((R4, b"t", "f000", "05", 1), "over one hour"), ((R4, b"t", "050000", "0003 05", 1), "too short")])
def test_profile_checks_headers(spark, cell, message):
    with pytest.raises(Exception, match=message):
        header_profile(cells_of(spark, [cell])).collect()


def test_profile_reads_values_of_append_cells_only(spark, archive):  # noqa: F811
    plan = header_profile(read_cells(spark, archive[0]))._jdf.queryExecution().executedPlan().toString()
    scans = [part[:900] for part in plan.split("FileScan")[1:]]
    with_values = [s for s in scans if "value:binary" in s.split("ReadSchema")[1].split("\n")[0]]
    assert len(scans) == 2 and len(with_values) == 1 and "EqualTo(qualifier" in with_values[0]


FIRST, LAST, DAYS = "2021-04-03T06:00:00Z", "2021-04-05T06:00:00Z", 1


def clean(spark, table):
    return sorted(map(str, read_points(spark, table).drop("tags").collect()))


@pytest.mark.parametrize("left", ["nothing", "all rows", "some rows"])
def test_broken_runs_go_on(spark, doubled, tmp_path, left):  # noqa: F811
    once, target, log = (str(tmp_path / name) for name in ("once", "target", "log"))
    dedupe(spark, doubled, once, FIRST, LAST, DAYS)
    slices = plan_slices(FIRST, LAST, DAYS)
    run = SliceLog(spark, log, slices)
    create_table(spark, target)
    points = read_points(spark, doubled)
    run.write(0, slices[0], dedupe_slice(points, slices[0]), target)
    run.begin(1, slices[1])
    if left != "nothing":
        rows = dedupe_slice(points, slices[1])
        append_points(rows if left == "all rows" else rows.filter("idx = 1"), target)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        dedupe(spark, doubled, target, FIRST, LAST, DAYS)
    dedupe(spark, doubled, target, FIRST, LAST, DAYS, log=log)
    assert clean(spark, target) == clean(spark, once)
    before = spark.read.json(log).count()
    dedupe(spark, doubled, target, FIRST, LAST, DAYS, log=log)  # nothing left to do
    assert spark.read.json(log).count() == before and read_points(spark, target).count() == ROWS


def test_mending_may_break_too(spark, doubled, tmp_path, monkeypatch):  # noqa: F811
    once, target, log = (str(tmp_path / name) for name in ("once", "target", "log"))
    dedupe(spark, doubled, once, FIRST, LAST, DAYS)
    from packedts.plans import slicelog

    append, overwrite = slicelog.append_points, slicelog.overwrite_days
    calls = []

    def breaking(write, at):
        def wrapped(rows, table):
            calls.append(1)
            write(rows, table)
            if len(calls) == at:
                raise OSError("lost")

        return wrapped

    monkeypatch.setattr(slicelog, "append_points", breaking(append, 2))
    with pytest.raises(OSError):
        dedupe(spark, doubled, target, FIRST, LAST, DAYS, log=log)
    monkeypatch.setattr(slicelog, "overwrite_days", breaking(overwrite, 3))
    with pytest.raises(OSError):
        dedupe(spark, doubled, target, FIRST, LAST, DAYS, log=log)
    dedupe(spark, doubled, target, FIRST, LAST, DAYS, log=log)
    assert clean(spark, target) == clean(spark, once)


def test_logs_of_other_slices_are_refused(spark, doubled, tmp_path):  # noqa: F811
    target, log = str(tmp_path / "target"), str(tmp_path / "log")
    dedupe(spark, doubled, target, FIRST, LAST, DAYS, log=log)
    with pytest.raises(ValueError, match="other slices"):
        dedupe(spark, doubled, target, FIRST, LAST, 2, log=log)


def test_tie_break_of_the_job(spark, doubled, tmp_path):  # noqa: F811
    target = str(tmp_path / "t")
    dedupe(spark, doubled, target, FIRST, LAST, DAYS, tie_break=[F.size("tags").desc(), F.col("tags")["a"].desc_nulls_last()])
    tags = {tuple(r.tags.items()) for r in read_points(spark, target).select("tags").collect()}
    assert (("a", "b"),) in tags


def test_one_rule_set_for_dictionaries(spark):
    uids = uids_of(spark, [(1, "metrics", "again"), (9, "odd", "x"), (9, "odd", "y")])
    faults = sorted((r.qualifier, r.uid, r.entries, r.fault) for r in dictionary_faults(uids).collect())
    assert faults == [("metrics", 1, 2, "duplicate id"), ("odd", 9, 2, "unknown kind")]
    with pytest.raises(ValueError, match="unknown UID kind: odd"):
        check_dictionary(uids)
    with pytest.raises(ValueError, match="duplicate UID: metrics 1"):
        check_dictionary(uids.filter("qualifier <> 'odd'"))


def test_long_ids(spark):
    cells = cells_of(spark, [(b"a", b"id", b"metrics", bytes(5), 1), (b"b", b"id", b"tagk", bytes(4), 1), (b"\0", b"id", b"tagk", bytes(9), 1), (b"c", b"name", b"tagk", bytes(9), 1)])
    assert [tuple(r) for r in long_ids(cells).collect()] == [("metrics", "a", 5)]
    with pytest.raises(Exception, match="at most 4 bytes long, got 5"):
        read_uids(cells).collect()
