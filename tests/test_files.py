import pytest
from pyspark.sql import functions as F
from vectors import R4, cells_of

from packedts.sources.cells import read_cells
from packedts.sources.files import budget_predicate, is_source_file, largest_first, list_files, within_budget

MB = 1_000_000


def listing(spark, *files):
    return spark.createDataFrame(list(files), "path string, length bigint")


def paths(files):
    return sorted(r.path for r in files.collect())


def test_names(spark):
    names = ["f3", "f1", ".tableinfo", "x.y", "q_$folder$", "_$folder$x", "0a1b2c"]
    kept = spark.createDataFrame([(n,) for n in names], "name string").filter(is_source_file(F.col("name")))
    assert [r.name for r in kept.collect()] == ["f3", "f1", "_$folder$x", "0a1b2c"]


def test_listing_is_recursive_and_reads_no_contents(spark, tmp_path):
    (tmp_path / "a" / "t").mkdir(parents=True)
    for name, size in [("a/t/f3", 7), ("f1", 3), ("x.y", 5), (".tableinfo", 5), ("q_$folder$", 5), ("a/empty", 0)]:
        (tmp_path / name).write_bytes(b"x" * size)
    files = list_files(spark, str(tmp_path))
    found = {r.path.split(tmp_path.name + "/")[1]: r.length for r in files.collect()}
    assert found == {"a/t/f3": 7, "f1": 3}
    assert "ReadSchema: struct<>" in files._jdf.queryExecution().executedPlan().toString()


def test_largest_first(spark):
    files = listing(spark, ("s/a", 1), ("s/b", 3), ("s/c", 3), ("s/d", 2))
    assert [r.path for r in largest_first(files).collect()] == ["s/b", "s/c", "s/d", "s/a"]


def test_budget_keeps_the_crossing_file(spark):
    files = listing(spark, ("s/a", 600 * MB), ("s/b", 600 * MB), ("s/c", MB))
    assert paths(within_budget(files, 1000 * MB)) == ["s/a", "s/b"]


def test_budget_met_exactly_takes_one_more(spark):
    files = listing(spark, ("s/a", 500), ("s/b", 500), ("s/c", 1), ("s/d", 1))
    assert paths(within_budget(files, 1000)) == ["s/a", "s/b", "s/c"]


@pytest.mark.parametrize("limit", [0, -1])
def test_no_budget(spark, limit):
    assert within_budget(listing(spark, ("s/a", 5), ("s/b", 5)), limit).count() == 2


@pytest.mark.parametrize("limit", [1, 7, 20, 33, 1000])
def test_budget_over_folders(spark, limit):
    files = [(f"s/{folder}/{name}", 1 + (folder * 5 + name) % 7) for folder in range(4) for name in range(5)]
    expected, total = [], 0
    for path, length in sorted(files):
        if total > limit:
            break
        expected.append(path)
        total += length
    table = listing(spark, *files)
    assert paths(within_budget(table, limit)) == expected
    assert paths(table.filter(budget_predicate(table, limit, F.col("path")))) == expected


def test_budget_of_nothing(spark):
    table = spark.createDataFrame([], "path string, length bigint")
    assert table.filter(budget_predicate(table, 5, F.col("path"))).count() == 0


@pytest.fixture
def store(spark, tmp_path):
    """Four cell files of one cell each, named as an archive names them."""
    for i, name in enumerate(["a/f1", "a/f2", "b/f1", "b/f2"]):
        cells = cells_of(spark, [(R4, b"t", "0000", "05", i)]).drop("file").coalesce(1)
        cells.write.parquet(str(tmp_path / "tmp" / str(i)))
        part = next((tmp_path / "tmp" / str(i)).glob("part-*.parquet"))
        target = tmp_path / "store" / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(part.read_bytes())
        (target.parent / f"x{i}.y").write_bytes(part.read_bytes())
    return str(tmp_path / "store")


def test_cells_carry_their_file(spark, store):
    cells = read_cells(spark, store, bare_names_only=True)
    found = {r.version: r.file.split("/store/")[1] for r in cells.collect()}
    assert found == {0: "a/f1", 1: "a/f2", 2: "b/f1", 3: "b/f2"}
    assert read_cells(spark, store).count() == 8


def test_input_limit(spark, store, monkeypatch):
    size = list_files(spark, store).agg(F.min("length")).first()[0]
    monkeypatch.setattr("packedts.sources.cells.GB", size + 1)
    cells = read_cells(spark, store, limit_gb=1, bare_names_only=True)
    assert sorted(r.version for r in cells.collect()) == [0, 1]
    scan = cells._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in scan
    assert read_cells(spark, store, limit_gb=0, bare_names_only=True).count() == 4


def test_skipped_files_are_not_opened(spark, store, tmp_path):
    (tmp_path / "store" / "broken.cells").write_bytes(b"not a table")
    assert read_cells(spark, store, bare_names_only=True).count() == 4


def test_vanished_files(spark, store, tmp_path):
    tolerant = read_cells(spark, store, bare_names_only=True)
    strict = read_cells(spark, store, bare_names_only=True, ignore_missing=False)
    (tmp_path / "store" / "a" / "f1").unlink()
    assert tolerant.count() == 3
    with pytest.raises(Exception, match="f1|FILE_NOT_EXIST|does not exist"):
        strict.select("value").collect()


def test_empty_folder(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert read_cells(spark, str(tmp_path / "none")).count() == 0
