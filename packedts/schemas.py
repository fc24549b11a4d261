"""Fixed schemas of the tables this engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

# One stored cell. A cell holds the points of one series for up to an hour.
CELLS = T.StructType(
    [
        T.StructField("row_key", T.BinaryType()),
        T.StructField("family", T.BinaryType()),
        T.StructField("qualifier", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("version", T.LongType()),
    ]
)

# One dictionary entry: id -> name, per kind ('metrics', 'tagk', 'tagv').
UIDS = T.StructType(
    [
        T.StructField("uid", T.IntegerType()),
        T.StructField("qualifier", T.StringType()),
        T.StructField("name", T.StringType()),
    ]
)

# One decoded sample.
POINTS = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("lsp_id", T.IntegerType()),
        T.StructField("circuit_id", T.IntegerType()),
        T.StructField("power_sign", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("version", T.LongType()),
        T.StructField("idx", T.IntegerType()),
    ]
)

POINT_COLUMNS = POINTS.fieldNames()

# Fixed values of the cell format.
POINT_FAMILY = b"t"
UID_FAMILY = b"id"
MAX_ID_ROW_KEY = b"\x00"
APPEND_QUALIFIER = b"\x05\x00\x00"
ANNOTATION_PREFIX = b"\x01"
UID_KINDS = ("metrics", "tagk", "tagv")
LSP_TAG = "bot"
CIRCUIT_TAG = "circuit"
SIGN_TAG = "sign"
SALT_BYTES = 1
TIME_BYTES = 4
MAX_PACKED_OFFSET = 3600  # seconds, inclusive
MAX_OFFSET = 4095  # largest offset that fits the 12 offset bits


def check_id_size(id_size: int) -> int:
    if not 1 <= id_size <= 4:
        raise ValueError(f"ids are 1 to 4 bytes long, got {id_size}")
    return id_size
