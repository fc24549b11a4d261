import pytest
from pyspark.sql import functions as F
from vectors import at, cells_of, row_key, uids_of

from packedts.operators.search import find_files, prune_cells

START, END = "2021-04-02T10:50:00Z", "2021-04-03T10:50:00Z"
OFFSETS = {"before": -1, "at start": 0, "inside": 3600, "at end": 86400, "after": 86401}


@pytest.fixture(scope="module")
def uids(spark):
    return uids_of(spark, [(2, "metrics", "volts"), (9, "tagv", "+2400"), (10, "tagv", "2401")]).cache()


def header(offset, kind=0):
    return (offset << 4 | kind).to_bytes(2, "big")


def cell(time, *tags, metric=1, version=1, append=False, salt="00", offset=0):
    """One point at the given second after the search start."""
    seconds = int(at(3000).timestamp()) + time - offset
    key = row_key(*tags, metric=metric, base=f"{seconds:08x}", salt=salt)
    if append:
        return (key, b"t", b"\x05\x00\x00", header(offset) + b"\x05", version)
    return (key, b"t", header(offset), b"\x05", version)


def store(spark, files):
    """Cells of several files."""
    parts = [cells_of(spark, rows, file) for file, rows in files.items()]
    cells = parts[0]
    for part in parts[1:]:
        cells = cells.unionByName(part)
    return cells


@pytest.fixture(scope="module")
def files(spark):
    listed = {name: [cell(time, (1, 1))] for name, time in OFFSETS.items()}
    listed["other metric"] = [cell(5, (1, 1), metric=2)]
    listed["other device"] = [cell(5, (1, 10))]
    listed["no device"] = [cell(5)]
    listed["same number, other text"] = [cell(5, (1, 9))]
    listed["far offset"] = [cell(86400, (1, 1), append=True, offset=4095), cell(0, (1, 1), append=True, offset=4095)]
    listed["base before start"] = [cell(0, (1, 1), append=True, offset=4095)]
    listed["several"] = [cell(1, (1, 1), version=1), cell(2, (1, 1), version=2, salt="03"), cell(90000, (1, 1))]
    return store(spark, listed).cache()


FOUND = {"at start", "inside", "at end", "same number, other text", "far offset", "base before start", "several"}


@pytest.mark.parametrize("options", [{}, {"prune": True}, {"prune": True, "salts": range(4)}, {"prune": True, "broadcast_bytes": 0}])
def test_files_with_matching_points(spark, files, uids, options):
    found = find_files(files, uids, "power", 2400, START, END, **options)
    assert found.columns == ["file"]
    assert sorted(r.file for r in found.collect()) == sorted(FOUND)


@pytest.mark.parametrize("prune", [False, True])
def test_nothing_found(spark, files, uids, prune):
    assert find_files(files, uids, "amps", 2400, START, END, prune=prune).count() == 0
    assert find_files(files, uids, "power", 1, START, END, prune=prune).count() == 0


def test_bad_cells_elsewhere_fail_the_plain_search_only(spark, uids):
    bad = cell(10**7, (1, 1), metric=2)
    cells = store(spark, {"a": [cell(0, (1, 1))], "b": [(*bad[:3], b"\x05\x00", 1)]})
    with pytest.raises(Exception, match="file b"):
        find_files(cells, uids, "power", 2400, START, END).collect()
    assert find_files(cells, uids, "power", 2400, START, END, prune=True).count() == 1


def test_bad_cells_in_range_fail_both(spark, uids):
    good = cell(0, (1, 1))
    cells = store(spark, {"a": [good], "b": [(*good[:3], b"\x05\x00", 1)]})
    for prune in (False, True):
        with pytest.raises(Exception, match="file b"):
            find_files(cells, uids, "power", 2400, START, END, prune=prune).collect()


def test_salts_give_ranges_of_the_stored_key(spark, files, uids, tmp_path):
    files.drop("file").write.parquet(str(tmp_path / "cells"))
    stored = spark.read.parquet(str(tmp_path / "cells"))
    pruned = prune_cells(stored, uids, "power", START, END, salts=[0, 3])
    assert "GreaterThanOrEqual(row_key" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == prune_cells(stored, uids, "power", START, END).count()


def test_three_byte_ids_that_do_not_fit(spark):
    uids = uids_of(spark, [(0x1000001, "metrics", "wide")])
    cells = cells_of(spark, [(row_key(id_size=3), b"t", "0000", "05", 1)])
    assert prune_cells(cells, uids, "wide", START, END, id_size=3).count() == 0
    assert prune_cells(cells, uids, "power", "2021-04-02T10:00:00Z", END, id_size=3).count() == 1


def test_salt_ranges_reach_past_a_first_pair_of_largest_ids(spark):
    cells = store(spark, {"a": [cell(86400, (0xFFFFFFFF, 0xFFFFFFFF), (1, 1))], "b": [cell(86401, (1, 1))]})
    for salts in (None, range(2)):
        kept = prune_cells(cells, uids_of(spark, []), "power", START, END, salts=salts)
        assert (salts, [r.file for r in kept.collect()]) == (salts, ["a"])


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_many_ids_for_one_name(spark, limit):
    names = [(100 + k, "metrics", "crowd") for k in range(150)]
    uids = uids_of(spark, names)
    cells = store(spark, {"a": [cell(5, (1, 1), metric=249)], "b": [cell(5, (1, 1), metric=1)], "c": [cell(-9000, (1, 1), metric=100)]})
    kept = prune_cells(cells, uids, "crowd", START, END, salts=[0], broadcast_bytes=limit)
    assert [r.file for r in kept.collect()] == ["a"]
    found = find_files(cells, uids, "crowd", 2400, START, END, prune=True, salts=[0])
    assert [r.file for r in found.collect()] == [r.file for r in find_files(cells, uids, "crowd", 2400, START, END).collect()]


def test_dense_cells_gather_events_not_points(spark):
    """What is shuffled for a cell are its 60 events, not their 3600 points; repeated and null ids count as before."""
    from packedts.fixtures import dense_cells
    from packedts.operators.counts import count_points

    rows = [(k, "click") for k in range(150)] + [(7, "click"), (None, "view")]
    cells = dense_cells(spark.createDataFrame(rows, "event_id long, event_type string"))
    assert "Generate" not in cells._jdf.queryExecution().optimizedPlan().toString()
    points = count_points(cells.filter("version IS NOT NULL").withColumn("file", F.lit("f")))
    assert points.first()[0] == 151 * 60
