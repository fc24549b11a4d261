"""The registered queries: every operator, run over the driver's tables.

The tables hold no cells, so the events are first packed into cell tables. Those
are stored once per session and table folder, as an archive would be, and every
query then starts from the stored cells.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packedts import fixtures
from packedts.functions.bytesx import be_int, be_long, be_short, be_unsigned, point_value
from packedts.functions.packing import pack_points
from packedts.operators.cellparts import cell_kind
from packedts.operators.counts import count_points, count_points_by_file, header_profile, row_count, time_range
from packedts.operators.decode import decode_errors, decode_points
from packedts.operators.dedupe import dedupe_points, dedupe_slice, plan_slices, slice_table
from packedts.operators.dictionary import dictionary_faults, long_ids, read_uids
from packedts.operators.fileindex import candidate_files, write_index
from packedts.operators.search import find_files, find_files_by_index
from packedts.operators.series import build_series
from packedts.plans.jobs import ConvertOptions, convert, dedupe
from packedts.plans.slicelog import SliceLog
from packedts.scratch import scratch_path
from packedts.sinks.points import append_points, create_table, replace_points
from packedts.sources.cells import read_cells, read_points
from packedts.sources.files import is_source_file, largest_first, within_budget

# Search and slice parameters; the oracles state the same ones.
METRIC, LSP_ID = "view", 0
START, END = "2024-01-05T10:50:00+00:00", "2024-01-08T10:50:00+00:00"
FIRST_SLICE, LAST_SLICE = "2024-01-05T00:00:00+00:00", "2024-01-25T00:00:00+00:00"
# The first and the last slices of this plan hold no points.
PLAN_FIRST, PLAN_LAST = "2023-12-16T00:00:00+00:00", "2024-02-05T00:00:00+00:00"
DENSE_SEARCH = ("click", 0, "2024-01-01T05:10:00+00:00", "2024-01-02T03:20:00+00:00")
BUDGET_BYTES = 2_000_000

_stored: dict[tuple[str, str, str], str] = {}


def _store(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a table written once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = scratch_path(spark, name)
        write(path)
        _stored[key] = path
    return _stored[key]


def _cells(spark: SparkSession, sf_dir: str, name: str = "cells", faults: bool = False, **encoding) -> DataFrame:
    return read_cells(spark, cells_path(spark, sf_dir, name, faults, **encoding))


def cells_path(spark: SparkSession, sf_dir: str, name: str = "cells", faults: bool = False, **encoding) -> str:
    def write(path: str) -> None:
        cells = fixtures.event_cells(fixtures.read_events(spark, sf_dir), **encoding)
        cells = fixtures.with_faults(cells) if faults else fixtures.with_bystanders(cells)
        fixtures.write_cells(cells, path)

    return _store(spark, sf_dir, name, write)


def uids_path(spark: SparkSession, sf_dir: str, id_size: int = 4) -> str:
    def write(path: str) -> None:
        fixtures.dictionary_cells(fixtures.read_events(spark, sf_dir), id_size).write.parquet(path)

    return _store(spark, sf_dir, f"uids{id_size}", write)


def _uids(spark: SparkSession, sf_dir: str, id_size: int = 4) -> DataFrame:
    return read_uids(read_cells(spark, uids_path(spark, sf_dir, id_size)))


def _points(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return decode_points(_cells(spark, sf_dir), _uids(spark, sf_dir), **options)


def _ntz(time: str) -> Column:
    return fixtures.utc_ntz(F.unix_seconds(time))


def _file_day(file: str = "file") -> Column:
    """The one part of a stored file's path that does not change from run to run."""
    return F.regexp_extract(file, "day=([0-9-]+)", 1)


def _flat(points: DataFrame) -> DataFrame:
    return points.select(
        "metric",
        _ntz("time").alias("time"),
        "value",
        "lsp_id",
        "circuit_id",
        "power_sign",
        F.col("tags")["src"].alias("src"),
        F.size("tags").alias("tag_count"),
        "version",
        "idx",
    )


def q_decode_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_points(spark, sf_dir))


def _short_form(points: DataFrame) -> DataFrame:
    return points.select("metric", "lsp_id", _ntz("time").alias("time"), "value", "version", "idx")


def q_decode_float32(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir, "cells-float32", encoding="float32")
    return _short_form(decode_points(cells, _uids(spark, sf_dir)))


def mixed_ints() -> Column:
    """Whole numbers of all four widths, either sign, mixed within cells."""
    cents = F.round(F.col("value") * 100)
    scale = (
        F.when(F.col("event_id") % 5 == 0, 1)
        .when(F.col("event_id") % 5 == 1, -1)
        .when(F.col("event_id") % 5 == 2, 1000)
        .when(F.col("event_id") % 5 == 3, -1000000000)
    )
    return F.when(scale.isNull(), F.col("event_id") % 128 - 64).otherwise(cents * scale)


def q_decode_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir, "cells-int", encoding="int", value=mixed_ints())
    return _short_form(decode_points(cells, _uids(spark, sf_dir)))


def q_decode_id3(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir, "cells-id3", id_size=3)
    return _flat(decode_points(cells, _uids(spark, sf_dir, 3), id_size=3))


def q_decode_compact_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same points where the dictionary fits in compact form only, and the series table not at all."""
    return _flat(_points(spark, sf_dir, broadcast_bytes=300))


def q_decode_series_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same points by a series table that is broadcast."""
    return _flat(_points(spark, sf_dir, compact_bytes=0))


def q_decode_without_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same points by the plans for lookup tables too large to broadcast in any form."""
    return _flat(_points(spark, sf_dir, broadcast_bytes=300, compact_bytes=0))


def q_uid_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _uids(spark, sf_dir)


def q_uid_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    uids = _uids(spark, sf_dir)
    metrics = uids.filter(F.col("qualifier") == "metrics")
    twice = metrics.filter(F.col("uid") % 2 == 0)
    strange = metrics.filter(F.col("uid") % 2 == 1).withColumn("qualifier", F.lit("other"))
    return dictionary_faults(uids.unionByName(twice).unionByName(strange))


def q_promoted_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir)
    return points.groupBy("metric", "lsp_id", "circuit_id", "power_sign", F.col("tags")["src"].alias("src")).agg(
        F.count("*").alias("points"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents")
    )


def _search(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    files = find_files(
        _cells(spark, sf_dir), _uids(spark, sf_dir), METRIC, LSP_ID, START, END, **options
    )
    return files.select(_file_day().alias("file")).distinct()


def q_search_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir)


def q_search_files_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, prune=True, salts=fixtures.SALTS)


def _index_path(spark: SparkSession, sf_dir: str) -> str:
    return _store(spark, sf_dir, "index", lambda path: write_index(_cells(spark, sf_dir), _uids(spark, sf_dir), path))


def q_search_files_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search by the side table, and whether it left files unopened."""
    index = _index_path(spark, sf_dir)
    found = find_files_by_index(spark, index, METRIC, LSP_ID, START, END)
    files = candidate_files(spark, index, METRIC, LSP_ID, START, END)
    opened = files.agg((F.sum(F.col("may_match").cast("int")) < F.count("*")).alias("skips"))
    return found.select(_file_day().alias("file")).distinct().join(F.broadcast(opened))


def q_file_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = spark.read.parquet(f"{_index_path(spark, sf_dir)}/files")
    return files.groupBy(_file_day().alias("file")).agg(
        F.sum("cells").alias("cells"), F.min("first_base").alias("first_base"), F.max("last_base").alias("last_base")
    )


def q_count_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_points(_cells(spark, sf_dir))


def q_count_points_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = count_points_by_file(_cells(spark, sf_dir))
    return files.groupBy(_file_day().alias("file")).agg(F.sum("points").alias("points"))


def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(_points(spark, sf_dir))


def q_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = time_range(_points(spark, sf_dir))
    return times.select(_ntz("min_time").alias("min_time"), _ntz("max_time").alias("max_time"))


def q_header_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points and time range without the values of packed cells."""
    profile = header_profile(_cells(spark, sf_dir))
    return profile.select("points", _ntz("min_time").alias("min_time"), _ntz("max_time").alias("max_time"))


def _dense_cells(spark: SparkSession, sf_dir: str, append: bool = False) -> DataFrame:
    """Cells of 3600 points each."""

    def write(path: str) -> None:
        fixtures.write_cells(fixtures.dense_cells(fixtures.read_events(spark, sf_dir), append=append), path)

    return read_cells(spark, _store(spark, sf_dir, f"cells-dense-{append}", write))


def q_search_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of one series of the dense cells, by decoding them all."""
    files = find_files(_dense_cells(spark, sf_dir), _uids(spark, sf_dir), *DENSE_SEARCH)
    return files.select(_file_day().alias("file")).distinct()


def q_search_dense_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search, which decodes only cells that can match."""
    files = find_files(_dense_cells(spark, sf_dir), _uids(spark, sf_dir), *DENSE_SEARCH, prune=True)
    return files.select(_file_day().alias("file")).distinct()


def q_search_dense_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search, which opens only files that can match, and whether others stayed closed."""
    cells, uids = _dense_cells(spark, sf_dir), _uids(spark, sf_dir)
    index = _store(spark, sf_dir, "index-dense", lambda path: write_index(cells, uids, path))
    files = candidate_files(spark, index, *DENSE_SEARCH)
    opened = files.agg((F.sum(F.col("may_match").cast("int")) < F.count("*")).alias("skips"))
    found = find_files_by_index(spark, index, *DENSE_SEARCH)
    return found.select(_file_day().alias("file")).distinct().join(F.broadcast(opened))


def _dense(spark: SparkSession, sf_dir: str, append: bool) -> DataFrame:
    """Points of the dense cells, summed up by the event that each minute of them was made from."""
    points = decode_points(_dense_cells(spark, sf_dir, append), _uids(spark, sf_dir))
    event = F.floor(F.col("version") / fixtures.DENSE_EVENTS) * fixtures.DENSE_EVENTS + F.floor(F.col("idx") / fixtures.DENSE_POINTS)
    return points.groupBy("metric", "lsp_id", event.alias("event_id")).agg(
        F.count("*").alias("points"),
        F.sum(F.col("value").cast("bigint")).alias("value"),
        F.sum((F.col("idx") % fixtures.DENSE_POINTS + 1) * F.col("value").cast("bigint")).alias("weighted"),
        _ntz(F.min("time")).alias("first"),
        _ntz(F.max("time")).alias("last"),
    )


def q_decode_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dense(spark, sf_dir, append=False)


def q_decode_dense_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dense(spark, sf_dir, append=True)


def q_missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a table whose listed files have since been replaced by others: none, and no error."""
    path = scratch_path(spark, "cells-vanishing")
    _cells(spark, sf_dir).drop("file").write.parquet(path)
    listed = read_cells(spark, path)
    _cells(spark, sf_dir).drop("file").limit(0).write.mode("overwrite").parquet(path)
    return listed.agg(F.count("value").alias("cells"))


def q_empty_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a table that has files of no bytes among its files, as an archive may."""
    path = scratch_path(spark, "cells-with-empty")
    cells = _cells(spark, sf_dir).drop("file")
    cells.write.parquet(path)
    cells.limit(0).select(F.lit("").alias("text")).write.mode("append").text(path)
    return read_cells(spark, path).groupBy(cell_kind().alias("kind")).agg(F.count("*").alias("cells"))


def q_long_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary entries that cannot be read: those of the metrics, with a byte too many put before their ids."""
    cells = read_cells(spark, uids_path(spark, sf_dir))
    longer = F.when(F.col("qualifier") == F.lit(b"metrics"), F.concat(F.lit(b"\x01"), F.col("value"))).otherwise(F.col("value"))
    return long_ids(cells.withColumn("value", longer))


def q_dedupe_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sliced run that broke in its third slice, after the rows were written, and was then run again."""
    source, target, log = _imported_with_copies(spark, sf_dir), scratch_path(spark, "points-resumed"), scratch_path(spark, "slices")
    slices = plan_slices(FIRST_SLICE, LAST_SLICE)
    broken = SliceLog(spark, log, slices)
    create_table(spark, target)
    points = read_points(spark, source)
    for number, part in enumerate(slices[:2]):
        broken.write(number, part, dedupe_slice(points, part), target)
    broken.begin(2, slices[2])
    append_points(dedupe_slice(points, slices[2]), target)
    dedupe(spark, source, target, FIRST_SLICE, LAST_SLICE, log=log)
    return _without_tags(read_points(spark, target))


def q_point_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir, provenance=True)
    return points.groupBy(_file_day().alias("file"), "metric", F.hex("salt").alias("salt")).agg(
        F.count("*").alias("points")
    )


def q_series_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = build_series(_cells(spark, sf_dir), _uids(spark, sf_dir)).rows
    return rows.select(
        "metric", "lsp_id", "circuit_id", "power_sign", F.col("tags")["src"].alias("src"), "cells", "series_error"
    )


def q_cell_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir).groupBy(cell_kind().alias("kind")).agg(F.count("*").alias("cells"))


def q_invalid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir, "cells-faulty", faults=True)
    errors = decode_errors(cells, _uids(spark, sf_dir))
    return errors.select(_file_day().alias("file"), "version", "error")


def _with_copies(points: DataFrame) -> DataFrame:
    """Every point twice; the copy differs in its tags only."""
    copies = points.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    tags = F.when(F.col("_copy") == 1, F.create_map(F.lit("copy"), F.lit("1"))).otherwise(F.col("tags"))
    return copies.withColumn("tags", tags).drop("_copy")


def _without_tags(points: DataFrame) -> DataFrame:
    return points.select(
        "metric", _ntz("time").alias("time"), "value", "lsp_id", "circuit_id", "power_sign", "version", "idx"
    )


def q_dedupe_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_tags(dedupe_points(_with_copies(_points(spark, sf_dir))))


def _imported_with_copies(spark: SparkSession, sf_dir: str) -> str:
    return _store(spark, sf_dir, "points-twice", lambda path: replace_points(_with_copies(_points(spark, sf_dir)), path))


def _deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "points-deduped")
    dedupe(spark, _imported_with_copies(spark, sf_dir), target, FIRST_SLICE, LAST_SLICE)
    return read_points(spark, target)


def q_dedupe_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_tags(_deduped(spark, sf_dir))


def q_slice_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slices of a dedupe run, and how many points each one has to handle."""
    slices = plan_slices(PLAN_FIRST, PLAN_LAST)
    held = F.array(*(F.coalesce(F.sum(s.predicate().cast("long")), F.lit(0)) for s in slices))
    sizes = read_points(spark, _imported_with_copies(spark, sf_dir)).agg(held.alias("held"))
    numbered = sizes.select(F.posexplode("held").alias("slice", "points"))
    return slice_table(spark, slices).select("slice", "predicate").join(numbered, "slice", "left")


def _unsorted_rows(table: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Per day: rows, and rows that come before their predecessor in their file."""
    in_file = Window.partitionBy("_file").orderBy("_row")
    key = F.struct(*order)
    rows = table.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    return (
        rows.withColumn("_unsorted", F.coalesce(key < F.lag(key).over(in_file), F.lit(False)).cast("int"))
        .groupBy(F.col("day").cast("string").alias("day"))
        .agg(F.count("*").alias("points"), F.sum("_unsorted").alias("unsorted"))
    )


def _converted(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    table = scratch_path(spark, "points")
    convert(spark, ConvertOptions(cells_path(spark, sf_dir), uids_path(spark, sf_dir), table, **options))
    return read_points(spark, table)


def _overlapping(table: DataFrame) -> DataFrame:
    """Per day: points, and files that begin before the one before them ends."""
    files = table.groupBy(F.col("day").cast("string").alias("day"), F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("points"), F.min("time").alias("low"), F.max("time").alias("high")
    )
    in_day = Window.partitionBy("day").orderBy("low", "high")
    overlap = F.coalesce(F.col("low") < F.lag("high").over(in_day), F.lit(False)).cast("int")
    files = files.withColumn("overlap", overlap)
    return files.groupBy("day").agg(F.sum("points").alias("points"), F.sum("overlap").alias("overlapping"))


def q_write_day_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default form: every file sorted, and files of a day with disjoint times."""
    table = _converted(spark, sf_dir)
    return _unsorted_rows(table, ("time",)).join(_overlapping(table).select("day", "overlapping"), "day")


def q_write_exact_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by a sort of the points: files of a day hold disjoint times."""
    return _overlapping(_converted(spark, sf_dir, exact_order=True))


def _quarantined(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Paths of the points and of the errors of one import of damaged cells."""
    table, errors = scratch_path(spark, "points-good"), scratch_path(spark, "cells-bad")
    cells = cells_path(spark, sf_dir, "cells-faulty", faults=True)
    convert(spark, ConvertOptions(cells, uids_path(spark, sf_dir), table, errors_to=errors))
    return table, errors


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points that came through an import of damaged cells, and the cells that did not, by day and reason."""
    table, errors = _quarantined(spark, sf_dir)
    points = read_points(spark, table).groupBy(F.date_format("day", "yyyy-MM-dd").alias("day"), F.lit("good").alias("outcome")).agg(F.count("*").alias("rows"))
    bad = spark.read.parquet(errors).groupBy(_file_day().alias("day"), F.col("error").alias("outcome")).agg(F.count("*").alias("rows"))
    return points.unionByName(bad)


def q_write_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _converted(spark, sf_dir, fanout=True)
    return table.groupBy(F.col("day").cast("string").alias("day"), "metric").agg(F.count("*").alias("points"))


def q_write_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unsorted_rows(_deduped(spark, sf_dir), ("metric", "lsp_id", "circuit_id", "time"))


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing that follows from the events: a folder per day, a file per type."""
    events = fixtures.read_events(spark, sf_dir)
    day = F.date_format("ts", "yyyy-MM-dd")
    path = F.concat(F.lit("archive/"), day, F.lit("/"), F.col("event_type"))
    return events.groupBy(path.alias("path")).agg(F.sum(F.col("event_id") % 1000 + 1).alias("length"))


def q_input_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return within_budget(_listing(spark, sf_dir), BUDGET_BYTES)


def q_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return largest_first(_listing(spark, sf_dir))


def q_source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The naming rule on names that keep, lose to a dot, or are folder markers."""
    suffix = (
        F.when(F.col("path").endswith("click"), ".tableinfo")
        .when(F.col("path").endswith("view"), "_$folder$")
        .when(F.col("path").endswith("signup"), ".d/f3")
        .otherwise("")
    )
    files = _listing(spark, sf_dir).withColumn("path", F.concat("path", suffix))
    return files.filter(is_source_file(F.substring_index("path", "/", -1)))


def q_big_endian(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of each width to big-endian bytes and back."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    signed = F.when(F.col("l_linenumber") % 2 == 0, -F.col("l_orderkey")).otherwise(F.col("l_orderkey"))
    lines = lines.select("l_orderkey", "l_linenumber", signed.cast("bigint").alias("n"))

    def encoded(number: Column, size: int) -> Column:
        return F.unhex(F.substring(F.lpad(F.hex(number.cast("bigint")), 16, "0"), 17 - 2 * size, 2 * size))

    n = F.col("n")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        be_short(encoded(n % 32768, 2)).alias("short_value"),
        be_int(encoded(n * 299, 4)).alias("int_value"),
        be_int(encoded(F.abs(n), 3)).alias("three_byte_value"),
        be_unsigned(encoded(n, 4)).alias("unsigned_value"),
        be_long(encoded(n * 1000000007, 8)).alias("long_value"),
    )


def q_value_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values to float and double bytes, and back by SQL expressions."""
    events = fixtures.read_events(spark, sf_dir)
    value = F.when(F.col("event_id") % 2 == 0, -F.col("value")).otherwise(F.col("value"))
    events = events.select("event_id", F.array(F.struct(F.lit(0).alias("offset"), value.alias("value"))).alias("point"))
    for encoding in ("float32", "float64"):
        events = events.withColumn(encoding, pack_points(F.col("point"), F.lit(False), encoding)["value"])
    return events.select(
        "event_id",
        *[point_value(F.col(encoding), F.lit(False)).alias(f"{encoding}_value") for encoding in ("float32", "float64")],
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: query for name, query in list(globals().items()) if name.startswith("q_")
}
