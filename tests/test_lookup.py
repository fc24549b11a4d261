"""Lookup tables of any size and skew give the same points."""

import pytest
from pyspark.sql import functions as F
from vectors import cells_of, row_key, uids_of

from packedts.operators.decode import decode_cells, decode_errors, decode_points
from packedts.operators.dictionary import ENTRY_BYTES, check_dictionary
from packedts.functions.names import compact_dictionary, name_batch
from packedts.operators.lookup import lookup
from packedts.operators.series import NamesInTask, SeriesTable, build_series, names_for
from packedts.schemas import CELLS

# One series holds a third of all cells, and one tag value is in every series.
SERIES = 60


@pytest.fixture(scope="module")
def skewed(spark):
    rows = []
    for i in range(SERIES):
        for n in range(1 if i else SERIES // 2):
            key = row_key((1, 1), (4, 100 + i), base=f"{0x6066EB20 + 3600 * n:08x}")
            rows.append((key, b"t", "0000", "05", len(rows)))
    rows.append((row_key((1, 9)), b"t", "0000", "05", len(rows)))
    rows.append((row_key()[:-1], b"t", "0000", "05", len(rows)))
    uids = uids_of(spark, [(100 + i, "tagv", f"site-{i}") for i in range(SERIES)])
    return cells_of(spark, rows).cache(), uids.cache()


def plain(points):
    return sorted((r.version, r.idx, r.value, r.metric, r.lsp_id, tuple(sorted(r.tags.items()))) for r in points.collect())


TIERS = [(0, 0), (700, 0), (4000, 0), (1 << 20, 0), (0, 1 << 20), (700, 1 << 20), (4200, 1 << 20)]


@pytest.mark.parametrize("limit, compact", TIERS)
def test_every_plan_gives_the_same_points(spark, skewed, limit, compact):
    cells, uids = skewed
    good = cells.filter(F.col("version") < cells.count() - 2)
    assert isinstance(names_for(good, uids, 4, limit, compact), NamesInTask if compact else SeriesTable)
    assert plain(decode_points(good, uids, broadcast_bytes=limit, compact_bytes=compact)) == plain(decode_points(good, uids))


@pytest.mark.parametrize("limit, compact", TIERS)
def test_every_plan_finds_the_same_errors(spark, skewed, limit, compact):
    cells, uids = skewed
    options = {"broadcast_bytes": limit, "compact_bytes": compact}

    def errors(**options):
        return sorted((r.version, r.error) for r in decode_errors(cells, uids, **options).collect())

    assert errors(**options) == errors()
    assert [text for _, text in errors()] == ["unknown tag value id", "row key of wrong length"]


def test_predicates_on_names_shrink_the_table(spark, skewed):
    cells, uids = skewed
    series = build_series(cells, uids, limit=700)
    one = series.where(F.col("tags")["site"] == "site-3")
    assert one.bytes <= 700 < series.bytes
    for compact in (0, 1 << 20):
        only = F.col("tags")["site"] == "site-3"
        assert decode_points(cells, uids, only=only, broadcast_bytes=700, compact_bytes=compact).count() == 1


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Many cells of 200 series, a third of them of one, as a table."""
    path = str(tmp_path_factory.mktemp("skew") / "cells")
    n = 30_000
    series = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 199 + 1)
    key = F.concat(F.lit(b"\0\0\0\0\1"), F.unhex(F.lpad(F.hex(F.lit(0x6066EB20) + 3600 * (F.col("id") % 500)), 8, "0")), F.lit(b"\0\0\0\4"), F.unhex(F.lpad(F.hex(100 + series), 8, "0")))
    cells = spark.range(n).select(key.alias("row_key"), F.lit(b"t").alias("family"), F.lit(b"\0\0").alias("qualifier"), F.lit(b"\5").alias("value"), "id")
    cells.withColumnRenamed("id", "version").repartition(6).write.parquet(path)
    return path, uids_of(spark, [(100 + i, "tagv", f"site-{i}") for i in range(200)]).cache()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_compact_names_move_no_cells(spark, stored):
    path, uids = stored
    points = decode_points(spark.read.schema(CELLS).parquet(path), uids, broadcast_bytes=1000)
    plan = plan_of(points)
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan
    assert points.groupBy(F.col("tags")["site"].alias("s")).count().filter("s = 'site-0'").first()["count"] == 10_000


def test_crowded_series_are_spread_in_one_scan(spark, stored):
    path, uids = stored
    cells = spark.read.schema(CELLS).parquet(path)
    points = decode_points(cells, uids, broadcast_bytes=1000, compact_bytes=0)
    plan = plan_of(points)
    assert plan.count("value:binary") == 1 and "Union" not in plan
    assert points.count() == 30_000
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        points = decode_points(cells, uids, broadcast_bytes=1000, compact_bytes=0)
        sizes = sorted(r["count"] for r in points.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_crowded_and_other_keys_together(spark, how):
    facts = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 200 + [2, 3, 9] + [None] * 50)], "k int, i int")
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, name string")
    small = sorted(map(str, lookup(facts, table, ["k"], 10, 10, how=how).collect()))
    counts = facts.groupBy("k").agg(F.count("*").alias("n"))
    large = sorted(map(str, lookup(facts, table, ["k"], 11, 10, counts, ["i"], how).collect()))
    assert small == large and len(small) == (253 if how == "left" else 202)


def test_compact_names_follow_the_series_table(spark):
    """Repeated tags, numbers of all kinds and unknown ids, by both ways to name a series."""
    values = ["12", "+5", "-7", "٣٤", "1.5", "", " 3", "2147483648", "007", "n/a", "𝟏", "x"]
    uids = [(1, "metrics", "m"), (2, "metrics", "é"), (-1, "metrics", "minus")]
    uids += [(i + 1, "tagk", name) for i, name in enumerate(["bot", "circuit", "sign", "site", "rack"])]
    uids += [(i + 1, "tagv", name) for i, name in enumerate(values)]
    uids = spark.createDataFrame(uids, "uid int, qualifier string, name string")
    rows = []
    for n in range(400):
        pairs = [((n * 7 + 3 * k) % 6 + (k % 2), (n * 5 + k * k) % 13) for k in range(n % 5)]
        key = b"\0" + [b"\0\0\0\1", b"\0\0\0\2", b"\xff\xff\xff\xff", b"\0\0\0\x09"][n % 4] + b"\0\0\0\0"
        rows.append((key + b"".join(i.to_bytes(4, "big") for pair in pairs for i in pair), b"t", b"\0\0", b"\5", n))
    cells = spark.createDataFrame(rows, CELLS)
    table = {bytes(r.series_key): r for r in build_series(cells, uids).rows.collect()}
    import pyarrow as pa

    keys = list(table)
    named = name_batch(pa.array([*keys, None, keys[0]], pa.binary()), 4, compact_dictionary(uids)).to_pylist()
    assert named[-2] is None and named[-1] == named[0]
    for key, names in zip(keys, named):
        row = table[key]
        assert dict(names["tags"]) == row.tags, row
        assert all(names[c] == row[c] for c in ("metric", "lsp_id", "circuit_id", "power_sign", "series_error")), (names, row)


def test_sizes_are_bounded_by_what_is_written(spark, skewed):
    cells, uids = skewed
    series = build_series(cells, uids)
    assert series.bytes == series.rows.agg(F.sum("_size")).first()[0]
    assert series.bytes > 96 * series.rows.count()
    assert check_dictionary(uids) > ENTRY_BYTES * SERIES


def test_series_that_appear_later_do_not_pass_unnamed(spark, skewed):
    cells, uids = skewed
    early = cells.filter(F.col("version") < 10)
    late = cells.filter(F.col("version") == SERIES // 2 + 5)
    found = decode_cells(late, build_series(early, uids)).select("error").collect()
    assert [r.error for r in found] == ["series not seen before"]
