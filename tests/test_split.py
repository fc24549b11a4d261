"""The point split against a plain reading of the format, byte by byte."""

import struct

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from packedts.functions import points as kernel
from packedts.functions.bytesx import be_unsigned, point_value
from packedts.functions.packing import pack_batch
from packedts.functions.points import split_batch

CODES = {0: ">b", 1: ">h", 3: ">i", 7: ">q", 11: ">f", 15: ">d"}


def read_cell(qualifier, value, is_append):
    """Points and error of one cell, read one point after the other."""
    points, at = [], 0

    def read(header, at):
        offset, kind = header >> 4, header & 15
        size = (kind & 7) + 1
        if not is_append and offset > 3600:
            return None, at, "offset over one hour"
        if kind not in CODES:
            return None, at, "unsupported value width"
        if at + size > len(value):
            return None, at, "value too short"
        return (offset, float(struct.unpack_from(CODES[kind], value, at)[0])), at + size, None

    if is_append:
        while at < len(value):
            if at + 2 > len(value):
                return points, "value too short"
            point, at, error = read(struct.unpack_from(">H", value, at)[0], at + 2)
            if error:
                return points, error
            points.append(point)
        return points, None
    for i in range(0, len(qualifier) - 1, 2):
        point, at, error = read(struct.unpack_from(">H", qualifier, i)[0], at)
        if error:
            return points, error
        points.append(point)
    rest = value[at:]
    if (len(points) == 1 and rest) or (len(points) > 1 and rest != b"\x00"):
        return points, "value bytes left over"
    return points, None


def split(cells):
    columns = [pa.array(list(column), type_) for column, type_ in zip(zip(*cells), (pa.binary(), pa.binary(), pa.bool_()))]
    return split_batch(*columns).to_pylist()


def same(found, expected):
    points, error = expected
    assert found["error"] == error
    if error is None:
        got = [(p["offset"], p["value"]) for p in found["points"]]
        assert [(o, struct.pack(">d", v)) for o, v in got] == [(o, struct.pack(">d", v)) for o, v in points]


number = st.integers(-(2**63), 2**63 - 1)
point = st.one_of(
    st.tuples(st.integers(0, 3600), st.sampled_from([0, 1, 3, 7]), number),
    st.tuples(st.integers(0, 3600), st.sampled_from([11, 15]), st.floats(width=32, allow_nan=False)),
)


@st.composite
def good_cell(draw):
    is_append = draw(st.booleans())
    qualifier = value = b""
    listed = draw(st.lists(point, max_size=12))
    for offset, kind, x in listed:
        header = struct.pack(">H", offset << 4 | kind)
        if kind in (0, 1, 3, 7):
            bits = 8 * (kind + 1)
            x = (x + 2 ** (bits - 1)) % 2**bits - 2 ** (bits - 1)
        body = struct.pack(CODES[kind], x)
        qualifier, value = (qualifier, value + header + body) if is_append else (qualifier + header, value + body)
    if is_append:
        return b"\x05\x00\x00", value, True
    return qualifier, value + (b"\x00" if len(listed) > 1 else b""), False


noise = st.tuples(st.binary(max_size=12).map(lambda b: b[: len(b) // 2 * 2]), st.binary(max_size=40), st.booleans())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(good_cell(), noise), min_size=1, max_size=20))
def test_split_reads_like_the_format(cells):
    for found, cell in zip(split(cells), cells):
        same(found, read_cell(*cell))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.one_of(good_cell(), noise), min_size=1, max_size=20), st.integers(1, 60))
def test_chunks_do_not_show(cells, size):
    before, kernel.CHUNK_BYTES = kernel.CHUNK_BYTES, size
    try:
        chunked = split(cells)
    finally:
        kernel.CHUNK_BYTES = before
    assert repr(chunked) == repr(split(cells))


def test_sliced_batches():
    cells = [(b"\x00\x00", bytes([i]), False) for i in range(10)]
    columns = [pa.array(list(column), type_) for column, type_ in zip(zip(*cells), (pa.binary(), pa.binary(), pa.bool_()))]
    found = split_batch(*[column.slice(4, 3) for column in columns]).to_pylist()
    assert [cell["points"][0]["value"] for cell in found] == [4.0, 5.0, 6.0]


@pytest.mark.parametrize("encoding", ["int", "float32", "float64"])
def test_pack_then_split(encoding):
    import random

    rng = random.Random(3)
    cells = []
    for n in [0, 1, 2, 5, 300]:
        for is_append in (False, True):
            values = [rng.randrange(-(2 ** rng.choice([6, 14, 30, 52])), 2**40) for _ in range(n)]
            if encoding == "float32":
                values = [struct.unpack(">f", struct.pack(">f", v))[0] for v in values]
            cells.append(([{"offset": rng.randrange(3601), "value": float(v)} for v in values], is_append))
    type_ = pa.list_(pa.struct([("offset", pa.int32()), ("value", pa.float64())]))
    flags = pa.array([a for _, a in cells])
    packed = pack_batch(pa.array([p for p, _ in cells], type_), flags, encoding)
    found = split_batch(packed.field(0), packed.field(1), flags).to_pylist()
    assert [(c["points"], c["error"]) for c in found] == [(p, None) for p, _ in cells]


@pytest.mark.parametrize("cut", [0, 3])
def test_large_batches_are_split_in_runs(monkeypatch, cut):
    """A worker holds the points of a run of cells, not those of a whole batch."""
    monkeypatch.setattr(kernel, "OUTPUT_BYTES", 200)
    qualifier = pa.array([b"\x05\x00\x00", struct.pack(">H", 16), b"", struct.pack(">HH", 16, 32)] * 50).slice(cut)
    value = pa.array([struct.pack(">HbHb", 16, 1, 32, 2) * 20, b"\x07", b"", b"\x01\x02\x00"] * 50).slice(cut)
    flags = pa.array([True, False, False, False] * 50).slice(cut)
    parts = list(kernel._split(iter([(qualifier, value, flags)])))
    assert max(map(len, parts)) < 10
    assert pa.chunked_array(parts).to_pylist() == split_batch(qualifier, value, flags).to_pylist()


def test_split_agrees_with_sql_expressions(spark):
    """The same split by SQL functions alone: slow for long cells, but independent."""
    rows = []
    for n in (1, 2, 7, 40):
        for seed in range(5):
            kinds = [(0, 1, 3, 7, 11, 15)[(seed + i * 5) % 6] for i in range(n)]
            qualifier = b"".join(struct.pack(">H", (i * 7) << 4 | k) for i, k in enumerate(kinds))
            value = b"".join(struct.pack(CODES[k], (i * 37 + seed) % 100 - 50) for i, k in enumerate(kinds))
            rows.append((len(rows), qualifier, value + (b"\x00" if n > 1 else b"")))
    cells = spark.createDataFrame(rows, "id int, qualifier binary, value binary")
    header = F.transform(
        F.sequence(F.lit(0), (F.octet_length("qualifier") / 2).cast("int") - 1),
        lambda i: be_unsigned(F.substring(F.col("qualifier"), i * 2 + 1, F.lit(2))).cast("int"),
    )
    empty = F.array().cast("array<struct<offset:int,start:int,size:int,is_int:boolean>>")

    def add(state, h):
        size = h.bitwiseAND(F.lit(7)) + 1
        start = F.coalesce(F.try_element_at(state, F.lit(-1))["start"] + F.try_element_at(state, F.lit(-1))["size"], F.lit(1))
        entry = F.struct(
            F.shiftright(h, 4).alias("offset"),
            start.alias("start"),
            size.alias("size"),
            (h.bitwiseAND(F.lit(8)) == 0).alias("is_int"),
        )
        return F.array_append(state, entry)

    by_sql = (
        cells.select("id", "value", F.posexplode(F.aggregate(header, empty, add)).alias("idx", "p"))
        .select("id", "idx", "p.offset", point_value(F.substring("value", F.col("p.start"), F.col("p.size")), F.col("p.is_int")).alias("x"))
        .collect()
    )
    by_split = cells.select(
        "id", F.posexplode(kernel.split_points(F.col("qualifier"), F.col("value"), F.lit(False))["points"]).alias("idx", "p")
    ).select("id", "idx", "p.offset", F.col("p.value").alias("x"))
    assert sorted(map(tuple, by_sql)) == sorted(map(tuple, by_split.collect()))
