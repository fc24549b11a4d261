"""What can be read off a cell without its points: kind, key parts, key faults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from packedts.functions.bytesx import be_int_sql
from packedts.schemas import ANNOTATION_PREFIX, APPEND_QUALIFIER, POINT_FAMILY, SALT_BYTES, TIME_BYTES

IGNORED, ANNOTATION, APPEND, PACKED, INVALID = "ignored", "annotation", "append", "packed", "invalid"


def _literal(data: bytes) -> str:
    return f"X'{data.hex()}'"


def is_point_family() -> Column:
    return F.expr(f"family = {_literal(POINT_FAMILY)}")


def cell_kind() -> Column:
    """Kind of a cell by family and qualifier."""
    return F.expr(
        f"""
        CASE WHEN family <> {_literal(POINT_FAMILY)} THEN '{IGNORED}'
             WHEN octet_length(qualifier) IN (3, 5) AND substring(qualifier, 1, 1) = {_literal(ANNOTATION_PREFIX)}
                 THEN '{ANNOTATION}'
             WHEN qualifier = {_literal(APPEND_QUALIFIER)} THEN '{APPEND}'
             WHEN octet_length(qualifier) % 2 = 1 THEN '{INVALID}'
             ELSE '{PACKED}' END"""
    )


def has_key_shape(id_size: int) -> Column:
    """Row key = salt, metric id, base time, then whole pairs of tag ids."""
    prefix = SALT_BYTES + id_size + TIME_BYTES
    return F.expr(
        f"octet_length(row_key) >= {prefix} AND (octet_length(row_key) - {prefix}) % {2 * id_size} = 0"
    )


def base_time_bytes(id_size: int) -> Column:
    """Base time as stored; compares like the unsigned number it is."""
    return F.expr(f"substring(row_key, {SALT_BYTES + id_size + 1}, {TIME_BYTES})")


def base_seconds(id_size: int) -> Column:
    return F.expr(f"cast(conv(hex(substring(row_key, {SALT_BYTES + id_size + 1}, {TIME_BYTES})), 16, 10) as bigint)")


def metric_id_bytes(id_size: int) -> Column:
    return F.expr(f"substring(row_key, {SALT_BYTES + 1}, {id_size})")


def series_key(id_size: int) -> Column:
    """Row key without salt and base time: metric id, then tag id pairs."""
    tags = SALT_BYTES + id_size + TIME_BYTES + 1
    return F.expr(f"concat(substring(row_key, {SALT_BYTES + 1}, {id_size}), substring(row_key, {tags}))")


def series_ids(id_size: int) -> Column:
    """Array of all ids in a series key: ``pos, qualifier, uid``.

    The metric has position -1; the key and value of a tag share the tag's position.
    """
    pair = 2 * id_size
    metric = be_int_sql(f"substring(series_key, 1, {id_size})")
    tagk = be_int_sql(f"substring(series_key, start, {id_size})")
    tagv = be_int_sql(f"substring(series_key, start + {id_size}, {id_size})")
    return F.expr(
        f"""
        concat(
            array(struct(-1 AS pos, 'metrics' AS qualifier, {metric} AS uid)),
            flatten(transform(
                if(octet_length(series_key) > {id_size},
                   sequence({id_size + 1}, octet_length(series_key) - {pair} + 1, {pair}), cast(array() as array<int>)),
                (start, i) -> array(struct(i AS pos, 'tagk' AS qualifier, {tagk} AS uid),
                                    struct(i AS pos, 'tagv' AS qualifier, {tagv} AS uid)))))"""
    )
