"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packedts.scratch import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: lineage ends, lost executors cost nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """id and root for every id in links (a, b): root is the least id reachable.

    Every step is a partial aggregation of minima and a join on the id, so no node's
    neighbours are gathered. Links to oneself are allowed; ids are long and not null.
    """
    edges = stored(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).distinct(), "links")
    state = None
    while True:
        # large star: every larger neighbour of a node is linked to the node's least neighbour
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node and its smaller neighbours are linked to the least of them
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        star = down.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        loops = edges.where("a = b")
        edges = stored(star.union(loops).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).union(edges.select("b", "b")).groupBy("id").agg(F.min("root").alias("root"))
