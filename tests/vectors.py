"""Cells and dictionary entries written out as bytes."""

from datetime import datetime, timedelta, timezone

from packedts.schemas import CELLS, UIDS

BASE = datetime(2021, 4, 2, 10, tzinfo=timezone.utc)

NAMES = [
    (1, "metrics", "power"),
    (1, "tagk", "bot"),
    (2, "tagk", "circuit"),
    (3, "tagk", "sign"),
    (4, "tagk", "site"),
    (1, "tagv", "2400"),
    (2, "tagv", "7"),
    (3, "tagv", "p"),
    (4, "tagv", "hq"),
    (5, "tagv", "n/a"),
    (6, "tagv", "x"),
]


def hexed(text):
    return bytes.fromhex(text.replace(" ", ""))


def row_key(*tags, metric=1, base="6066eb20", id_size=4, salt="00"):
    ids = b"".join(i.to_bytes(id_size, "big") for pair in tags for i in pair)
    return hexed(salt) + metric.to_bytes(id_size, "big") + hexed(base) + ids


R4 = row_key((1, 1), (2, 2), (3, 3), (4, 4))
R3 = row_key((1, 1), id_size=3)


def at(seconds):
    return BASE + timedelta(seconds=seconds)


def cells_of(spark, rows, file="f1"):
    """Cells from (row key, family, qualifier, value, version) rows."""
    rows = [(k, f, hexed(q) if isinstance(q, str) else q, hexed(v) if isinstance(v, str) else v, n) for k, f, q, v, n in rows]
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, CELLS).withColumn("file", F.lit(file))


def one_cell(spark, qualifier, value, key=R4, family=b"t", version=1):
    return cells_of(spark, [(key, family, qualifier, value, version)])


def uids_of(spark, extra=()):
    return spark.createDataFrame([*NAMES, *extra], UIDS)
