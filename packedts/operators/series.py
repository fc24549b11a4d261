"""Names for the series of cells.

Names are resolved once per series instead of once per point, in one of three ways:

* The id dictionary is sent to every executor in compact form, and every task names the
  series it meets. Cells are read once and nothing is stored or moved. This is the way
  while the dictionary's measured size allows it.
* Beyond that a series table is built, every distinct series with its names. It is
  written to the shared scratch folder, which keeps the pass over the cells to one
  (columns ``row_key`` and ``family`` only) and makes its size known before the join
  back to the cells is planned. A small one is broadcast.
* A large one is joined by one shuffle of the cells, crowded series spread out.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from packedts.functions.names import compact_dictionary, series_names
from packedts.operators.cellparts import has_key_shape, is_point_family, series_ids, series_key
from packedts.operators.dictionary import check_dictionary
from packedts.operators.lookup import BROADCAST_BYTES, lookup
from packedts.schemas import CIRCUIT_TAG, LSP_TAG, SIGN_TAG, check_id_size
from packedts.scratch import scratch_path

# Largest dictionary that every Python worker holds in compact form.
COMPACT_BYTES = 256 << 20
# What a row of the series table takes besides its key and names.
SERIES_BYTES = 96
ROW_BYTES = f"""{SERIES_BYTES} + octet_length(series_key) + coalesce(octet_length(metric), 0) + coalesce(octet_length(power_sign), 0)
    + aggregate(map_entries(tags), 0, (n, e) -> n + octet_length(e.key) + octet_length(e.value) + 16)"""


def series_keys(cells: DataFrame, id_size: int) -> DataFrame:
    """Distinct series keys with the number of cells each one has."""
    return (
        cells.filter(is_point_family() & has_key_shape(id_size))
        .groupBy(series_key(id_size).alias("series_key"))
        .agg(F.count("*").alias("cells"))
    )


# All decimal digits of the basic plane count, as in the format's own number parser.
_DIGITS = [chr(c) for c in range(0x10000) if unicodedata.category(chr(c)) == "Nd"]
_ASCII_NAME = f"translate(name, '{''.join(_DIGITS)}', '{''.join(str(unicodedata.digit(d)) for d in _DIGITS)}')"
# INT of a signed decimal number with nothing around it, a line end included, else NULL.
LENIENT_INT = rf"CASE WHEN {_ASCII_NAME} RLIKE '^[+-]?[0-9]+\\z' THEN try_cast({_ASCII_NAME} AS INT) END"


def _with_names(ids: DataFrame, uids: DataFrame, size: int, limit: int) -> DataFrame:
    """Ids with the ``name`` each has in the dictionary, or NULL."""
    on = ["qualifier", "uid"]
    if size <= limit:
        return lookup(ids, uids, on, size, limit)
    counts = ids.groupBy(*on).agg(F.count("*").alias("n"))
    return lookup(ids, uids, on, size, limit, counts, ["series_key", "pos"])


def name_series(keys: DataFrame, uids: DataFrame, id_size: int, uid_bytes: int, limit: int) -> DataFrame:
    """One row per series: names, typed tags, tag map, and the first fault found.

    While the dictionary is small enough to broadcast, the shuffle that made the
    keys distinct serves the regrouping too.
    """
    ids = keys.select("series_key", "cells", F.inline(series_ids(id_size)))
    tags = (
        _with_names(ids, uids, uid_bytes, limit)
        .groupBy("series_key", "cells", "pos")
        .agg(
            F.expr("max(CASE WHEN qualifier <> 'tagv' THEN name END) AS key"),
            F.expr("max(CASE WHEN qualifier = 'tagv' THEN name END) AS name"),
        )
    )
    # max_by passes over rows without an ordering value: a tag that does not parse
    # leaves the one before it standing.
    number = f"max_by({LENIENT_INT}, CASE WHEN pos >= 0 AND key = '{{tag}}' AND {LENIENT_INT} IS NOT NULL THEN pos END)"
    named = tags.groupBy("series_key", "cells").agg(
        F.expr("max(CASE WHEN pos < 0 THEN key END) AS metric"),
        F.expr(number.format(tag=LSP_TAG)).alias("lsp_id"),
        F.expr(number.format(tag=CIRCUIT_TAG)).alias("circuit_id"),
        F.expr(f"max_by(name, CASE WHEN pos >= 0 AND key = '{SIGN_TAG}' AND name IS NOT NULL THEN pos END) AS power_sign"),
        F.expr(
            f"""sort_array(collect_list(struct(pos, key, name)) FILTER (
                WHERE pos >= 0 AND name IS NOT NULL AND key NOT IN ('{LSP_TAG}', '{CIRCUIT_TAG}', '{SIGN_TAG}'))) AS _tags"""
        ),
        F.expr(
            """min(CASE WHEN pos < 0 AND key IS NULL THEN struct(pos, 0 AS step, 'unknown metric id' AS text)
                        WHEN key IS NULL THEN struct(pos, 0 AS step, 'unknown tag key id' AS text)
                        WHEN pos >= 0 AND name IS NULL THEN struct(pos, 1 AS step, 'unknown tag value id' AS text)
                   END) AS _fault"""
        ),
    )
    # The last of the tags with one key stays.
    kept = "filter(_tags, (tag, i) -> NOT exists(slice(_tags, i + 2, size(_tags)), later -> later.key = tag.key))"
    return named.selectExpr(
        "series_key",
        "cells",
        "metric",
        "lsp_id",
        "circuit_id",
        "power_sign",
        f"map_from_entries(transform({kept}, tag -> struct(tag.key, tag.name))) AS tags",
        "_fault.text AS series_error",
    )


@dataclass(frozen=True)
class SeriesTable:
    """A stored series table and its size; ``_size`` has the bytes of each row."""

    rows: DataFrame
    bytes: int
    limit: int

    def where(self, predicate: Column) -> SeriesTable:
        """The series that satisfy a predicate on their names."""
        rows, size = self.rows.filter(predicate), self.bytes
        if size > self.limit:
            size = rows.agg(F.coalesce(F.sum("_size"), F.lit(0)).alias("n")).first()["n"]
        return SeriesTable(rows, size, self.limit)

    def attach(self, cells: DataFrame, how: str = "left") -> DataFrame:
        """Cells (with ``series_key``) and the names of their series."""
        counts = self.rows.select("series_key", F.col("cells").alias("n"))
        names = self.rows.drop("cells", "_size")
        return lookup(cells, names, ["series_key"], self.bytes, self.limit, counts, ["row_key", "version"], how)


@dataclass(frozen=True)
class NamesInTask:
    """The compact dictionary on every executor; cells are named where they are read."""

    dictionary: Broadcast
    id_size: int
    predicate: Column | None = None

    def where(self, predicate: Column) -> NamesInTask:
        return NamesInTask(self.dictionary, self.id_size, predicate if self.predicate is None else self.predicate & predicate)

    def attach(self, cells: DataFrame, how: str = "left") -> DataFrame:
        """Cells (with ``series_key``) and the names of their series; with ``how`` inner, those that satisfy the predicate."""
        names = series_names(F.col("series_key"), self.id_size, self.dictionary)
        named = cells.withColumn("_names", names).select("*", "_names.*").drop("_names")
        return named.filter(self.predicate) if how == "inner" and self.predicate is not None else named


def build_series(
    cells: DataFrame, uids: DataFrame, id_size: int = 4, limit: int = BROADCAST_BYTES, uid_bytes: int | None = None
) -> SeriesTable:
    """Build and store the series table of ``cells``, with a checked dictionary of ``uid_bytes``, or after a check."""
    spark = cells.sparkSession
    check_id_size(id_size)
    if uid_bytes is None:
        uid_bytes = check_dictionary(uids)
    keys = series_keys(cells, id_size)
    if uid_bytes > limit:
        # The keys are read several times below: once over the cells is enough.
        path = scratch_path(spark, "series-keys")
        keys.write.parquet(path)
        keys = spark.read.schema(keys.schema).parquet(path)
    rows = name_series(keys, uids, id_size, uid_bytes, limit)
    rows = rows.withColumn("_size", F.expr(ROW_BYTES))
    path, written = scratch_path(spark, "series"), Observation()
    rows.observe(written, F.sum("_size").alias("bytes")).write.parquet(path)
    return SeriesTable(spark.read.schema(rows.schema).parquet(path), written.get["bytes"] or 0, limit)


def names_for(
    cells: DataFrame, uids: DataFrame, id_size: int = 4, limit: int = BROADCAST_BYTES, compact: int = COMPACT_BYTES
) -> SeriesTable | NamesInTask:
    """Check the dictionary, then choose the way by which cells get their names."""
    check_id_size(id_size)
    uid_bytes = check_dictionary(uids)
    if uid_bytes <= compact:
        return NamesInTask(cells.sparkSession.sparkContext.broadcast(compact_dictionary(uids)), id_size)
    return build_series(cells, uids, id_size, limit, uid_bytes)
