"""A PySpark engine for archives of packed time-series cells."""

from packedts.operators.counts import count_points, count_points_by_file, row_count, time_range
from packedts.operators.decode import decode_errors, decode_points
from packedts.operators.dedupe import dedupe_points, plan_slices
from packedts.operators.dictionary import check_dictionary, read_uids
from packedts.operators.search import find_files
from packedts.plans.jobs import ConvertOptions, SearchOptions, convert, count, dedupe, search
from packedts.scratch import scratch_tables
from packedts.sources.cells import read_cells, read_points

__all__ = [
    "ConvertOptions",
    "SearchOptions",
    "check_dictionary",
    "convert",
    "count",
    "count_points",
    "count_points_by_file",
    "decode_errors",
    "decode_points",
    "dedupe",
    "dedupe_points",
    "find_files",
    "plan_slices",
    "read_cells",
    "read_points",
    "read_uids",
    "row_count",
    "scratch_tables",
    "search",
    "time_range",
]
