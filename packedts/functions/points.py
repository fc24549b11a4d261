"""Split packed cells into points, one Arrow batch at a time.

A cell's points lie end to end with mixed widths, so the start of each value
is a running sum over the ones before it. SQL expressions for that cost
quadratic time in the points per cell; numpy does a whole batch in a handful of
passes. Only the two byte columns enter Python, names and tags stay in the JVM.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Workers get this module inside the pickled function, so that a cluster needs
# no copy of the package on its executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT_TYPE = "points array<struct<offset:int,value:double>>, error string"
PIECES_TYPE = "pieces array<struct<target:int,first:int,offsets:array<int>,values:array<double>>>, error string"

# Position in this list = error code, 0 = no error.
ERRORS = (
    "",
    "offset over one hour",
    "unsupported value width",
    "value too short",
    "value bytes left over",
)
OFFSET_ERROR, WIDTH_ERROR, SHORT_ERROR, LEFTOVER_ERROR = 1, 2, 3, 4
MAX_PACKED_SECONDS = 3600  # fixed value of the format

# (flag nibble of the point qualifier) -> big-endian numpy type; fixed values.
POINT_TYPES = {0: ">i1", 1: ">i2", 3: ">i4", 7: ">i8", 11: ">f4", 15: ">f8"}
KNOWN_KINDS = np.isin(np.arange(16), list(POINT_TYPES))


# Cells are split in runs of about this many value bytes, which keeps the
# working arrays small however large the Arrow batch is.
CHUNK_BYTES = 1 << 19
# What is decoded goes back to the JVM in runs of cells of about this many bytes, so a worker
# holds the batch it was sent, but never all points of that batch, several times as large.
OUTPUT_BYTES = 1 << 21


def _bytes_and_bounds(column):
    """The bytes of a binary column and each row's start and end in them."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    # Padding lets reads at the very end stay inside the buffer.
    return np.concatenate([data[bounds[0] : bounds[-1]], np.zeros(10, np.uint8)]), bounds - bounds[0]


def _gather(data, positions, dtype):
    """Values of a big-endian type that start at the given byte positions."""
    size = np.dtype(dtype).itemsize
    return np.lib.stride_tricks.sliding_window_view(data, size)[positions].view(dtype).ravel()


def _ordinals(counts):
    """0, 1, 2, ... within each of the runs."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _walked(data, start, end):
    """Where the points of these append cells start, by cell, and points per cell."""
    size = end - start
    at = np.cumsum(size) - size
    place = np.repeat(start - at, size) + np.arange(int(size.sum()))
    width = data[np.minimum(place + 1, len(data) - 1)] & 7
    done = len(place)
    following = np.arange(done, dtype=np.int32) + 3 + width
    following[following >= np.repeat(at + size, size)] = done
    jump = np.append(following, done).astype(np.int32)
    found = np.zeros(done + 1, bool)
    reached = at[size > 0].astype(np.int32)
    while len(reached):
        found[reached] = True
        known = np.flatnonzero(found[:done])
        reached = jump[known]
        reached = reached[reached < done]
        reached = reached[~found[reached]]
        jump = jump[jump]
    known = np.flatnonzero(found[:done])
    return place[known], np.searchsorted(known, at + size) - np.searchsorted(known, at)


def _append_starts(data, start, end):
    """Where each point of the append cells starts, and points per cell.

    Cells whose points are all as wide as the first take one vector pass; in the
    others the way from point to point is doubled until no cell has more.
    """
    step = 3 + (data[start + 1] & 7).astype(np.int64)
    counts = -((start - end) // step)
    row = np.repeat(np.arange(len(start)), counts)
    starts = start[row] + step[row] * _ordinals(counts)
    mixed = np.unique(row[(data[starts + 1] & 7) + 3 != step[row]])
    if not len(mixed):
        return starts, counts
    walked, counts[mixed] = _walked(data, start[mixed], end[mixed])
    uniform = np.ones(len(start), bool)
    uniform[mixed] = False
    kept = starts[uniform[row]]
    in_walked = ~np.repeat(uniform, counts)
    starts = np.empty(len(in_walked), np.int64)
    starts[in_walked] = walked
    starts[~in_walked] = kept
    return starts, counts


def _split_chunk(q_data, q_bounds, v_data, v_bounds, is_append):
    """Points per cell, their offsets and values, and the error code per cell."""
    q_start, v_start, v_end = q_bounds[:-1], v_bounds[:-1], v_bounds[1:]
    counts = np.where(is_append, 0, np.diff(q_bounds) // 2)
    append_rows = np.flatnonzero(is_append)
    if len(append_rows):
        append_starts, counts[append_rows] = _append_starts(v_data, v_start[append_rows], v_end[append_rows])
    cell = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    first = np.repeat(ends - counts, counts)
    ordinal = np.arange(len(cell)) - first

    # Read every point's own qualifier: offset, flag nibble, width.
    if len(append_rows):
        in_append = is_append[cell]
        point = np.empty(len(cell), ">u2")
        point[in_append] = _gather(v_data, append_starts, ">u2")
        point[~in_append] = _gather(q_data, (q_start[cell] + 2 * ordinal)[~in_append], ">u2")
    else:
        point = _gather(q_data, q_start[cell] + 2 * ordinal, ">u2")
    point = point.astype(np.int32)
    offset, kind = point >> 4, point & 15
    width = (point & 7) + 1

    # Start of each value: running width within the cell, or behind its qualifier.
    running = np.cumsum(width, dtype=np.int64) - width
    position = v_start[cell] + running - running[first]
    if len(append_rows):
        position[in_append] = append_starts + 2
    value_end, limit = position + width, v_end[cell]

    # Checks in reverse order of precedence: the one a reader trips over first wins.
    fault = np.where(value_end > limit, np.int8(SHORT_ERROR), np.int8(0))
    fault[~KNOWN_KINDS[kind]] = WIDTH_ERROR
    too_far = offset > MAX_PACKED_SECONDS
    if len(append_rows):
        fault[in_append & (position > limit)] = SHORT_ERROR
        too_far &= ~in_append
    fault[too_far] = OFFSET_ERROR

    error = np.zeros(len(counts), np.int32)
    # A packed cell with points must be used up, but for a zero byte after several.
    packed = np.flatnonzero(~is_append & (counts > 0))
    used = value_end[ends[packed] - 1]
    several = counts[packed] > 1
    last_byte = v_data[np.minimum(used, len(v_data) - 1)]
    complete = (used == v_end[packed] - several) & (~several | (last_byte == 0))
    error[packed[~complete]] = LEFTOVER_ERROR
    faulty = np.flatnonzero(fault)
    bad_cells, earliest = np.unique(cell[faulty], return_index=True)
    error[bad_cells] = fault[faulty[earliest]]

    decoded = np.zeros(len(cell), np.float64)
    kinds = np.unique(kind)
    for code in kinds.tolist():
        if code in POINT_TYPES:
            rows = slice(None) if len(kinds) == 1 and not len(faulty) else np.flatnonzero((kind == code) & (fault == 0))
            decoded[rows] = _gather(v_data, position[rows], POINT_TYPES[code])
    return counts, offset, decoded, error


def _split_rows(qualifier, value, is_append):
    """Points per cell, their offsets and values, and the error code per cell, of a whole batch."""
    q_data, q_bounds = _bytes_and_bounds(qualifier)
    v_data, v_bounds = _bytes_and_bounds(value)
    is_append = is_append.to_numpy(zero_copy_only=False).astype(bool)
    parts = []
    row, rows = 0, len(is_append)
    while row < rows or not parts:
        stop = max(row + 1, int(np.searchsorted(v_bounds, v_bounds[row] + CHUNK_BYTES, "right")) - 1)
        stop = min(stop, rows)
        q, v = q_bounds[row : stop + 1], v_bounds[row : stop + 1]
        parts.append(
            _split_chunk(
                q_data[q[0] : q[-1] + 10], q - q[0], v_data[v[0] : v[-1] + 10], v - v[0], is_append[row:stop]
            )
        )
        row = stop
    return (np.concatenate(column) for column in zip(*parts))


def _lists(starts, values):
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values)


def _messages(error):
    return pa.array(ERRORS).take(pa.array(error, mask=error == 0))


def split_batch(qualifier, value, is_append):
    """Points of each cell as struct<points, error>, same length as the input."""
    counts, offset, decoded, error = _split_rows(qualifier, value, is_append)
    flat = pa.StructArray.from_arrays([pa.array(offset), pa.array(decoded)], ["offset", "value"])
    points = _lists(np.append(0, np.cumsum(counts)), flat)
    return pa.StructArray.from_arrays([points, _messages(error)], ["points", "error"])


def split_batch_at(qualifier, value, is_append, base, spread, bounds):
    """Pieces of each cell, runs of points that belong to one time range, as struct<pieces, error>.

    Range i holds the times from bounds[i - 1] up to bounds[i]. A second that stands in several
    bounds is shared by the ranges between them, cell by cell.
    """
    counts, offset, decoded, error = _split_rows(qualifier, value, is_append)
    cell = np.repeat(np.arange(len(counts)), counts)
    time = base.to_numpy(zero_copy_only=False)[cell] + offset
    target = np.searchsorted(bounds, time, "right")
    shares = np.maximum(1, target - np.searchsorted(bounds, time, "left"))
    target = target - spread.to_numpy(zero_copy_only=False)[cell] % shares
    begins = np.ones(len(cell), bool)
    begins[1:] = (cell[1:] != cell[:-1]) | (target[1:] != target[:-1])
    piece = np.flatnonzero(begins)
    ends = np.cumsum(counts)
    first = piece - (ends - counts)[cell[piece]]
    starts = np.append(piece, len(cell))
    columns = [
        pa.array(target[piece], pa.int32()),
        pa.array(first, pa.int32()),
        _lists(starts, pa.array(offset)),
        _lists(starts, pa.array(decoded)),
    ]
    pieces = pa.StructArray.from_arrays(columns, ["target", "first", "offsets", "values"])
    per_cell = np.bincount(cell[piece], minlength=len(counts))
    return pa.StructArray.from_arrays([_lists(np.append(0, np.cumsum(per_cell)), pieces), _messages(error)], ["pieces", "error"])


def _runs(qualifier: pa.Array, value: pa.Array) -> Iterator[slice]:
    """Runs of cells with about OUTPUT_BYTES of qualifiers and values each, at least one cell."""
    sizes = pc.add(*(pc.fill_null(pc.binary_length(c), 0).cast(pa.int64()) for c in (qualifier, value)))
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
    row, done = 0, 0
    while row < len(ends):
        stop = max(row + 1, int(np.searchsorted(ends, done + OUTPUT_BYTES, "right")))
        yield slice(row, stop)
        row, done = stop, ends[stop - 1]


def _split(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for batch in batches:
        for run in _runs(batch[0], batch[1]):
            yield split_batch(*(column[run] for column in batch))


def split_points(qualifier: Column, value: Column, is_append: Column) -> Column:
    """Column struct<points, error> of packed or append cells.

    Marked nondeterministic, which stops Catalyst from moving filters on the
    result below the split: every cell is decoded and checked, whatever is asked
    of its points later, and none is split twice.
    """
    return F.arrow_udf(_split, SPLIT_TYPE).asNondeterministic()(qualifier, value, is_append)


def split_points_at(qualifier: Column, value: Column, is_append: Column, base: Column, spread: Column, bounds: np.ndarray) -> Column:
    """Column struct<pieces, error> of packed or append cells: their points, parted at the times ``bounds``.

    ``base`` is the second that offsets count from; ``spread``, a non-negative number, deals
    cells out where ranges share a second.
    """

    def split(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            for run in _runs(batch[0], batch[1]):
                yield split_batch_at(*(column[run] for column in batch), bounds)

    return F.arrow_udf(split, PIECES_TYPE).asNondeterministic()(qualifier, value, is_append, base, spread)


def _times_and_append_minutes(base, qualifier, is_append):
    """Seconds of all points of packed cells by their qualifiers, and the first minute of every append cell."""
    q_data, q_bounds = _bytes_and_bounds(qualifier)
    base = base.to_numpy(zero_copy_only=False).astype(np.int64)
    appended = is_append.to_numpy(zero_copy_only=False).astype(bool)
    counts = np.where(appended, 0, np.diff(q_bounds) // 2)
    cell = np.repeat(np.arange(len(counts)), counts)
    offset = _gather(q_data, q_bounds[:-1][cell] + 2 * _ordinals(counts), ">u2").astype(np.int64) >> 4
    return base[cell] + offset, base[appended] // 60


def _counted(unit, points, appends):
    """A table of how often each number stands in two arrays."""
    places, at = np.unique(np.concatenate([points, appends]), return_inverse=True)
    counts = [np.bincount(part, minlength=len(places)) for part in (at[: len(points)], at[len(points) :])]
    return pa.table({unit: places, "points": counts[0], "appends": counts[1]})


def minute_counts(cells: DataFrame) -> DataFrame:
    """Rows (minute, points, appends) of cells (base, qualifier, is_append), several for a minute.

    An append cell counts in each minute of its hour.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times, minutes = _times_and_append_minutes(*batch.columns)
            hours = (minutes[:, None] + np.arange(60)).ravel()
            yield from _counted("minute", times // 60, hours).to_batches()

    return cells.mapInArrow(count, "minute long, points long, appends long")


def second_counts(cells: DataFrame, minutes: np.ndarray) -> DataFrame:
    """Rows (second, points, appends) in the given minutes, sorted; an append cell counts in each second of its hour."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times, firsts = _times_and_append_minutes(*batch.columns)
            times = times[np.isin(times // 60, minutes)]
            low, high = np.searchsorted(minutes, firsts), np.searchsorted(minutes, firsts + 60)
            held = minutes[np.repeat(low, high - low) + _ordinals(high - low)]
            yield from _counted("second", times, (held[:, None] * 60 + np.arange(60)).ravel()).to_batches()

    return cells.mapInArrow(count, "second long, points long, appends long")


HEADER_TYPE = "points int, first int, last int"


def _headers(qualifier: pa.Array) -> pa.Array:
    """Points, first and last offset that each packed qualifier announces; null offsets where there are none."""
    data, bounds = _bytes_and_bounds(qualifier)
    counts = np.diff(bounds) // 2
    rows = np.flatnonzero(counts)
    offset = _gather(data, np.repeat(bounds[:-1], counts) + 2 * _ordinals(counts), ">u2").astype(np.int32) >> 4
    begins = (np.cumsum(counts) - counts)[rows]
    ends = []
    for reduce in (np.minimum.reduceat, np.maximum.reduceat):
        column = np.zeros(len(counts), np.int32)
        if len(rows):
            column[rows] = reduce(offset, begins)
        ends.append(pa.array(column, mask=counts == 0))
    return pa.StructArray.from_arrays([pa.array(counts.astype(np.int32)), *ends], ["points", "first", "last"])


def header_of(qualifier: Column) -> Column:
    """Column struct<points, first, last> of packed cells; the value is not needed."""
    return F.arrow_udf(_headers, HEADER_TYPE).asNondeterministic()(qualifier)
