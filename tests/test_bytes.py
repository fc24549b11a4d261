import random
import struct

import pytest
from pyspark.sql import functions as F

from packedts.functions.bytesx import be_double, be_float, be_int, be_long, be_short, be_unsigned, point_value

RANDOM = random.Random(7)


def decoded(spark, values, code, column):
    rows = [(bytearray(struct.pack(code, value)),) for value in values]
    return [row[0] for row in spark.createDataFrame(rows, "b binary").select(column(F.col("b"))).collect()]


@pytest.mark.parametrize("code, bits, column", [(">h", 16, be_short), (">i", 32, be_int), (">q", 64, be_long)])
def test_integers_round_trip(spark, code, bits, column):
    edge = 1 << (bits - 1)
    values = [0, 1, -1, edge - 1, -edge, *(RANDOM.randrange(-edge, edge) for _ in range(500))]
    assert decoded(spark, values, code, column) == values


def test_every_short(spark):
    values = list(range(-(1 << 15), 1 << 15))
    assert decoded(spark, values, ">h", be_short) == values


@pytest.mark.parametrize("code, column", [(">f", be_float), (">d", be_double)])
def test_floats_round_trip(spark, code, column):
    size = struct.calcsize(code)
    specials = [0.0, -0.0, float("inf"), float("-inf"), 1.0, -2.25]
    smallest = struct.unpack(code, (1).to_bytes(size, "big"))[0]
    patterns = [RANDOM.randbytes(size) for _ in range(2000)]
    subnormals = [bytes(size // 4) + RANDOM.randbytes(size - size // 4) for _ in range(200)]
    values = [*specials, smallest, *(struct.unpack(code, p)[0] for p in [*patterns, *subnormals])]
    for expected, got in zip(values, decoded(spark, values, code, column)):
        assert struct.pack(">d", expected) == struct.pack(">d", got) or (expected != expected and got != got)


def test_short_input_is_zero_extended(spark):
    rows = spark.createDataFrame([(bytearray(b"\xff\xff\xff"),), (bytearray(),)], "b binary")
    assert [tuple(r) for r in rows.select(be_int(F.col("b")), be_long(F.col("b")), be_unsigned(F.col("b"))).collect()] == [
        (0xFFFFFF, 0xFFFFFF, 0xFFFFFF),
        (0, 0, 0),
    ]


@pytest.mark.parametrize("column, size", [(be_short, 3), (be_int, 5), (be_long, 9)])
def test_too_many_bytes(spark, column, size):
    rows = spark.createDataFrame([(bytearray(size),)], "b binary")
    with pytest.raises(Exception, match="too many bytes"):
        rows.select(column(F.col("b"))).collect()


def test_point_values(spark):
    rows = [
        (bytes.fromhex("05"), True, 5.0),
        (bytes.fromhex("ff"), True, -1.0),
        (bytes.fromhex("fffe"), True, -2.0),
        (bytes.fromhex("ffffffff"), True, -1.0),
        (bytes.fromhex("0020000000000001"), True, 9007199254740992.0),
        (bytes.fromhex("3fc00000"), False, 1.5),
        (bytes.fromhex("3dcccccd"), False, 0.10000000149011612),
        (bytes.fromhex("c002000000000000"), False, -2.25),
    ]
    table = spark.createDataFrame(rows, "b binary, is_int boolean, expected double")
    assert table.filter(point_value(F.col("b"), F.col("is_int")) != F.col("expected")).count() == 0


@pytest.mark.parametrize("size, is_int", [(3, True), (5, True), (6, True), (7, True), (1, False), (2, False), (3, False)])
def test_unsupported_widths(spark, size, is_int):
    rows = spark.createDataFrame([(bytearray(size), is_int)], "b binary, is_int boolean")
    with pytest.raises(Exception, match="unsupported value width"):
        rows.select(point_value(F.col("b"), F.col("is_int"))).collect()
