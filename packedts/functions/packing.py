"""Pack points into cells: the inverse of the point split, for test data."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PACK_TYPE = "qualifier binary, value binary"
APPEND_QUALIFIER = b"\x05\x00\x00"  # fixed value of the format
INT_TYPES = ((0, ">i1"), (1, ">i2"), (3, ">i4"), (7, ">i8"))  # flag nibble, big-endian type
# Points are packed in runs of about this many, whose working arrays stay small however large the Arrow batch is.
CHUNK_POINTS = 1 << 17
FLOAT_TYPES = {"float32": (11, ">f4"), "float64": (15, ">f8")}


def _binary(lengths, data):
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def pack_batch(points, is_append, encoding):
    """Qualifier and value bytes of each row's ``list<struct<offset, value>>``."""
    bounds = points.offsets.to_numpy().astype(np.int64)
    flat = points.values.slice(bounds[0], bounds[-1] - bounds[0])
    bounds = bounds - bounds[0]
    offset = flat.field(0).to_numpy(zero_copy_only=False)
    value = flat.field(1).to_numpy(zero_copy_only=False)
    counts = np.diff(bounds)
    is_append = is_append.to_numpy(zero_copy_only=False).astype(bool)
    cell = np.repeat(np.arange(len(counts)), counts)
    ordinal = np.arange(len(offset)) - bounds[cell]
    appended = is_append[cell]

    if encoding == "int":
        kind = np.select(
            [(value >= -(2 ** (8 * size - 1))) & (value < 2 ** (8 * size - 1)) for size in (1, 2, 4)], [0, 1, 3], 7
        )
        types = INT_TYPES
    else:
        types = (FLOAT_TYPES[encoding],)
        kind = np.full(len(offset), types[0][0])
    header = ((offset.astype(np.uint32) << 4) | kind).astype(">u2").view(np.uint8).reshape(-1, 2)

    span = (kind & 7) + 1 + 2 * appended
    trailer = ~is_append & (counts > 1)
    lengths = np.bincount(cell, span, len(counts)).astype(np.int64) + trailer
    start = np.cumsum(span) - span + (np.cumsum(trailer) - trailer)[cell]
    data = np.zeros(int(lengths.sum()), np.uint8)
    body = start + 2 * appended
    for code, dtype in types:
        rows = np.flatnonzero(kind == code)
        size = (code & 7) + 1
        data[body[rows][:, None] + np.arange(size)] = value[rows].astype(dtype).view(np.uint8).reshape(-1, size)
    data[start[appended][:, None] + np.arange(2)] = header[appended]

    q_lengths = np.where(is_append, len(APPEND_QUALIFIER), 2 * counts)
    q_start = np.cumsum(q_lengths) - q_lengths
    q_data = np.zeros(int(q_lengths.sum()), np.uint8)
    q_data[q_start[is_append][:, None] + np.arange(3)] = np.frombuffer(APPEND_QUALIFIER, np.uint8)
    in_packed = ~appended
    q_data[(q_start[cell] + 2 * ordinal)[in_packed][:, None] + np.arange(2)] = header[in_packed]
    return pa.StructArray.from_arrays([_binary(q_lengths, q_data), _binary(lengths, data)], ["qualifier", "value"])


def pack_points(points: Column, is_append: Column, encoding: str = "float64") -> Column:
    """Column struct<qualifier, value> of an array of (offset, value) structs.

    ``encoding`` is float64, float32, or int, which takes the narrowest width. Nondeterministic for the
    planner, like the point split, so that both byte columns come from one run.
    """

    def pack(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for points, is_append in batches:
            bounds = points.offsets.to_numpy()
            row = 0
            while row < len(points):
                stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + CHUNK_POINTS, "right")) - 1)
                yield pack_batch(points.slice(row, stop - row), is_append.slice(row, stop - row), encoding)
                row = stop

    return F.arrow_udf(pack, PACK_TYPE).asNondeterministic()(points, is_append)
