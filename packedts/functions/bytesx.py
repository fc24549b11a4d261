"""Column helpers for big-endian bytes, built from Spark functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def be_unsigned(data: Column) -> Column:
    """Big-endian bytes (at most 7) as an unsigned BIGINT; no bytes give 0."""
    return F.coalesce(F.conv(F.hex(data), 16, 10).cast("bigint"), F.lit(0).cast("bigint"))


def be_int_sql(data: str) -> str:
    """SQL text for 1 to 4 big-endian bytes as INT."""
    unsigned = f"cast(conv(hex({data}), 16, 10) as bigint)"
    return f"cast(shiftright(shiftleft({unsigned}, 32), 32) as int)"


def _signed(data: Column, bytes_: int, type_: str) -> Column:
    """Two's complement over ``bytes_`` bytes; shorter input is zero-extended."""
    if bytes_ < 8:
        # Shifting up and down again copies the sign bit to the front.
        unused = 64 - 8 * bytes_
        return F.shiftright(F.shiftleft(be_unsigned(data), unused), unused).cast(type_)
    # 64 bits overflow BIGINT as an unsigned number, so join two 32-bit halves.
    padded = F.lpad(F.hex(data), 16, "0")
    high = F.conv(F.substring(padded, 1, 8), 16, 10).cast("bigint")
    low = F.conv(F.substring(padded, 9, 8), 16, 10).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(low).cast(type_)


def _checked(data: Column, bytes_: int, type_: str) -> Column:
    too_long = F.concat(F.lit(f"too many bytes for {type_}: "), F.octet_length(data).cast("string"))
    return F.when(F.octet_length(data) > bytes_, F.raise_error(too_long).cast(type_)).otherwise(
        _signed(data, bytes_, type_)
    )


def be_short(data: Column) -> Column:
    """Up to 2 big-endian bytes as SMALLINT; longer input raises."""
    return _checked(data, 2, "smallint")


def be_int(data: Column) -> Column:
    """Up to 4 big-endian bytes as INT; longer input raises."""
    return _checked(data, 4, "int")


def be_long(data: Column) -> Column:
    """Up to 8 big-endian bytes as BIGINT; longer input raises."""
    return _checked(data, 8, "bigint")


def _ieee(sign: Column, exponent: Column, mantissa: Column, bits: int, bias: int) -> Column:
    scale = F.lit(float(2**bits))
    special = 2 * bias + 1  # all exponent bits set
    magnitude = (
        F.when((exponent == special) & (mantissa != 0), F.lit(float("nan")))
        .when(exponent == special, F.lit(float("inf")))
        # Two factors keep the smallest subnormal step from underflowing early.
        .when(exponent == 0, mantissa.cast("double") / scale * F.pow(F.lit(2.0), F.lit(1.0 - bias)))
        .otherwise((F.lit(1.0) + mantissa.cast("double") / scale) * F.pow(F.lit(2.0), (exponent - bias).cast("double")))
    )
    return F.when(sign != 0, -magnitude).otherwise(magnitude)


def be_float(data: Column) -> Column:
    """4 big-endian bytes of an IEEE float as DOUBLE."""
    bits = be_int(data).cast("bigint")
    return _ieee(
        bits.bitwiseAND(F.lit(0x80000000)),
        F.shiftright(bits, 23).bitwiseAND(F.lit(0xFF)),
        bits.bitwiseAND(F.lit(0x7FFFFF)),
        23,
        127,
    )


def be_double(data: Column) -> Column:
    """8 big-endian bytes of an IEEE double as DOUBLE."""
    bits = be_long(data)
    return _ieee(
        F.shiftrightunsigned(bits, 63),
        F.shiftrightunsigned(bits, 52).bitwiseAND(F.lit(0x7FF)),
        bits.bitwiseAND(F.lit((1 << 52) - 1)),
        52,
        1023,
    )


def point_value(data: Column, is_int: Column) -> Column:
    """One point's value bytes as DOUBLE; widths other than 1, 2, 4, 8 raise,
    and so do floats of width 1 and 2."""
    width = F.octet_length(data)
    unsupported = F.raise_error(F.concat(F.lit("unsupported value width "), width.cast("string"))).cast("double")
    whole = (
        F.when(width == 1, _signed(data, 1, "bigint"))
        .when(width == 2, be_short(data).cast("bigint"))
        .when(width == 4, be_int(data).cast("bigint"))
        .when(width == 8, be_long(data))
        .cast("double")
    )
    return (
        F.when(is_int & width.isin(1, 2, 4, 8), whole)
        .when(~is_int & (width == 4), be_float(data))
        .when(~is_int & (width == 8), be_double(data))
        .otherwise(unsupported)
    )
