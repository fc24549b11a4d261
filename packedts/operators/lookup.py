"""Joins against lookup tables whose size has been measured."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest lookup table that is copied to every executor.
BROADCAST_BYTES = 64 << 20

# A key with more than 1/n of a partition's share of the rows is spread over several tasks.
UNITS = 16


def lookup(
    facts: DataFrame,
    table: DataFrame,
    on: list[str],
    size: int,
    limit: int = BROADCAST_BYTES,
    counts: DataFrame | None = None,
    spread: Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """Join ``facts`` to ``table``, which has unique keys ``on`` and ``size`` bytes.

    Small tables are broadcast and ``facts`` does not move. Larger ones are joined by
    a shuffle; ``counts`` says how many facts each key has (columns ``on`` and ``n``), and
    the facts of crowded keys are dealt out by the columns ``spread``.
    """
    if size <= limit:
        return facts.join(F.broadcast(table), on, how)
    if counts is None:
        return facts.join(table, on, how)
    return _spread_join(facts, table, on, counts, spread, how)


def _spread_join(
    facts: DataFrame, table: DataFrame, on: list[str], counts: DataFrame, spread: Sequence[str], how: str
) -> DataFrame:
    """One scan and one shuffle of ``facts``, however its keys are distributed.

    A crowded key gets so many salts that none holds more than 1/UNITS of what a partition
    has on average, and its row of the table a copy for each. Fewer than UNITS keys a
    partition can be crowded, which bounds what is broadcast. Null keys match nothing and
    are dealt out too.
    """
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    unit = max(1, total // (UNITS * partitions))
    crowded = counts.filter(F.col("n") > unit).select(*on, F.ceil(F.col("n") / unit).cast("int").alias("_copies"))
    crowded = F.broadcast(crowded)
    salts = F.when(F.col(on[0]).isNull(), UNITS * partitions).otherwise(F.coalesce("_copies", F.lit(1)))
    salted = facts.join(crowded, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int")).drop("_copies")
    copies = F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)
    copied = table.join(crowded, on, "left").withColumn("_salt", F.explode(copies)).drop("_copies")
    return salted.join(copied, [*on, "_salt"], how).drop("_salt")
