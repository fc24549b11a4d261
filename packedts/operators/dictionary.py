"""The id dictionary: reading it from cells and checking it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packedts.functions.bytesx import be_int
from packedts.schemas import MAX_ID_ROW_KEY, UID_FAMILY, UID_KINDS

# What an entry takes besides its name: kind, id and row overhead.
ENTRY_BYTES = 56
ID_BYTES = 4


def _text(data: str):
    # Malformed UTF-8 is replaced, not refused.
    return F.make_valid_utf8(F.col(data).cast("string"))


def _entries(cells: DataFrame) -> DataFrame:
    return cells.filter((F.col("family") == F.lit(UID_FAMILY)) & (F.col("row_key") != F.lit(MAX_ID_ROW_KEY)))


def _too_long():
    return F.octet_length("value") > ID_BYTES


def read_uids(cells: DataFrame) -> DataFrame:
    """Dictionary entries ``uid, qualifier, name`` held by a table of id cells.

    An id of more than 4 bytes raises.
    """
    message = F.concat(F.lit(f"ids are at most {ID_BYTES} bytes long, got "), F.octet_length("value").cast("string"))
    return (
        _entries(cells)
        # In a filter the check survives column pruning.
        .filter(F.when(_too_long(), F.raise_error(message).cast("boolean")).otherwise(True))
        .select(be_int(F.col("value")).alias("uid"), _text("qualifier").alias("qualifier"), _text("row_key").alias("name"))
    )


def long_ids(cells: DataFrame) -> DataFrame:
    """The entries that ``read_uids`` refuses: ``qualifier, name`` and how many ``bytes`` their id has."""
    return _entries(cells).filter(_too_long()).select(
        _text("qualifier").alias("qualifier"), _text("row_key").alias("name"), F.octet_length("value").alias("bytes")
    )


UNKNOWN_KIND, DUPLICATE_ID = "unknown kind", "duplicate id"


def _by_id(uids: DataFrame) -> DataFrame:
    """Entries per kind and id, their bytes, and what makes them unusable."""
    fault = F.when(~F.col("qualifier").isin(*UID_KINDS), UNKNOWN_KIND).when(F.col("entries") > 1, DUPLICATE_ID)
    bytes_ = F.sum(F.octet_length("name") + F.lit(ENTRY_BYTES))
    return uids.groupBy("qualifier", "uid").agg(F.count("*").alias("entries"), bytes_.alias("bytes")).withColumn("fault", fault)


def dictionary_faults(uids: DataFrame) -> DataFrame:
    """Entries that make a dictionary unusable: ids used twice, unknown kinds."""
    return _by_id(uids).filter("fault IS NOT NULL").drop("bytes")


def check_dictionary(uids: DataFrame) -> int:
    """Raise if the dictionary is unusable, else say how many bytes it takes.

    One aggregation, one row to the driver.
    """
    # unknown kinds first
    fault = F.struct((F.col("fault") == DUPLICATE_ID).alias("rank"), "qualifier", "uid", "fault")
    row = _by_id(uids).agg(
        F.min(F.when(F.col("fault").isNotNull(), fault)).alias("fault"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    ).first()
    fault = row["fault"]
    if fault is None:
        return row["bytes"]
    if fault["fault"] == UNKNOWN_KIND:
        raise ValueError(f"unknown UID kind: {fault['qualifier']}")
    raise ValueError(f"duplicate UID: {fault['qualifier']} {fault['uid']}")
