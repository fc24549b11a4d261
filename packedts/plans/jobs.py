"""The four jobs: import, search, count, deduplicate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from packedts.operators.counts import count_points, row_count
from packedts.operators.decode import decode_apart, decode_points
from packedts.operators.dedupe import dedupe_slice, plan_slices, slice_table
from packedts.operators.dictionary import read_uids
from packedts.operators.lookup import BROADCAST_BYTES
from packedts.operators.search import find_files
from packedts.operators.series import COMPACT_BYTES
from packedts.operators.timeorder import time_bounds
from packedts.plans.slicelog import SliceLog
from packedts.scratch import scratch_tables
from packedts.sinks.points import append_points, create_table, replace_points
from packedts.sources.cells import read_cells, read_points


@dataclass(frozen=True)
class ConvertOptions:
    metric_dir: str
    uid_dir: str
    output_table: str
    id_size: int = 4
    fanout: bool = False
    limit_gb: int = 0
    dry_run: bool = False
    exact_order: bool = False
    partitions: int | None = None
    format: str = "parquet"
    bare_names_only: bool = False
    errors_to: str | None = None
    broadcast_bytes: int = BROADCAST_BYTES
    compact_bytes: int = COMPACT_BYTES


@dataclass(frozen=True)
class SearchOptions:
    metric_dir: str
    uid_dir: str
    metric: str
    lsp_id: int
    start: str | datetime
    end: str | datetime
    id_size: int = 4
    prune: bool = False
    format: str = "parquet"
    bare_names_only: bool = False
    salts: tuple[int, ...] | None = None
    broadcast_bytes: int = BROADCAST_BYTES
    compact_bytes: int = COMPACT_BYTES


def _uids(spark: SparkSession, options: ConvertOptions | SearchOptions) -> DataFrame:
    return read_uids(
        read_cells(spark, options.uid_dir, format=options.format, bare_names_only=options.bare_names_only)
    )


def convert(spark: SparkSession, options: ConvertOptions) -> int | None:
    """Decode a cell table and replace the output table with its points.

    The table is partitioned by day and in one global time order: every file is sorted, and the
    files of a day hold disjoint ranges of time. Cells are cut at the ends of the ranges and their
    pieces shuffled; ``exact_order`` sorts the points themselves instead, by sampled ranges, which
    shuffles many times the bytes. A dry run decodes and checks everything, writes nothing and
    returns the count.

    A bad cell fails the job, unless ``errors_to`` names a folder: then the good cells are imported and
    the bad ones written there, with file and reason. Scratch tables are gone when the job ends.
    """
    if options.dry_run and options.errors_to:
        raise ValueError("a dry run writes nothing, errors neither")
    with scratch_tables(spark):
        cells = read_cells(
            spark,
            options.metric_dir,
            format=options.format,
            limit_gb=options.limit_gb,
            bare_names_only=options.bare_names_only,
        )
        arranged = not (options.dry_run or options.fanout or options.exact_order)
        bounds = time_bounds(cells, options.id_size, options.partitions) if arranged else None
        named = {"bounds": bounds, "broadcast_bytes": options.broadcast_bytes, "compact_bytes": options.compact_bytes}
        if options.errors_to:
            points, errors = decode_apart(cells, _uids(spark, options), options.id_size, **named)
            errors.write.mode("overwrite").parquet(options.errors_to)
        else:
            points = decode_points(cells, _uids(spark, options), options.id_size, **named)
        if options.dry_run:
            return row_count(points).first()["points"]
        replace_points(
            points, options.output_table, fanout=options.fanout, arranged=arranged, partitions=options.partitions
        )
        return None


def search(spark: SparkSession, options: SearchOptions) -> DataFrame:
    """Files that hold points of a metric and device in a time range."""
    cells = read_cells(spark, options.metric_dir, format=options.format, bare_names_only=options.bare_names_only)
    return find_files(
        cells,
        _uids(spark, options),
        options.metric,
        options.lsp_id,
        options.start,
        options.end,
        options.id_size,
        prune=options.prune,
        salts=options.salts,
        broadcast_bytes=options.broadcast_bytes,
        compact_bytes=options.compact_bytes,
    )


def count(spark: SparkSession, metric_dir: str, *, format: str = "parquet", bare_names_only: bool = False) -> int:
    """Points announced by the qualifiers of a cell table. Missing files fail the job."""
    cells = read_cells(
        spark, metric_dir, format=format, bare_names_only=bare_names_only, ignore_missing=False, tag_file=False
    )
    return count_points(cells).first()["points"]


def dedupe(
    spark: SparkSession,
    source: str,
    target: str,
    first: str | datetime = "2021-03-01T00:00:00+00:00",
    last: str | datetime = "2022-12-01T00:00:00+00:00",
    step_days: int = 10,
    dry_run: bool = False,
    *,
    tie_break: Sequence[Column] = (),
    log: str | None = None,
) -> DataFrame:
    """Copy a point table without its copies, slice by slice, into a new table.

    Each slice is a job of its own: it bounds what is in flight, and the finished
    slices outlive a failure. The target must not exist yet, unless ``log`` names a folder that
    tells of an earlier run: then that run goes on after its last finished slice. What a broken run may need
    again stays in the scratch folder. Returns the slice plan; a dry run does nothing else.
    """
    slices = plan_slices(first, last, step_days)
    if not dry_run:
        points = read_points(spark, source)
        progress = SliceLog(spark, log, slices) if log else None
        create_table(spark, target, if_missing=progress is not None and progress.continues)
        for number, part in enumerate(slices):
            found = dedupe_slice(points, part, tie_break)
            if progress is None:
                append_points(found, target)
            elif not progress.is_done(number):
                progress.write(number, part, found, target)
    return slice_table(spark, slices)
