"""Mixing sources to target weights by Sainte-Laguë apportionment.

Each source gets a target number of words: weights repeat over the sources in code-point
order, share a multiple of all words, and stop at a multiple of what the source holds; the
excess goes to the others by weight. The targets are then met in blocks of equal size:
integer quotas of blocks go to the sources by highest quotients, target / (2k - 1), and each
source's quota goes to its shards the same way. A shard lays its documents in seeded order on
a ring of blocks and takes its quota as full rounds plus one seeded run of blocks, so which
words of a document are taken follows by arithmetic, and no row stands for a block.

Scale: documents are reduced to (doc_id, source, size) in the first projection, unless the
caller has a column carried along. Shards hold a
bounded number of words, so the running sum over a shard is one bounded window group however
large its source is. Joins with per-source and per-shard rows are salted. Only the
apportionment itself orders all sources, a few candidate rows each.

Defined results: a null text has size 0; a null source is a source of its own and the last
one; repeated rows count as often as they occur; an empty table gives no rows; a source
without words has target 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packedts.llm.components import stored

SALTS = 16


@dataclass(frozen=True)
class Mix:
    """Weights in turn over the sources, their share of all words, and the blocks."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    repeats: int = 2
    block_words: int = 16
    shard_words: int = 8_000_000
    seed: int = 17


def word_count(text: Column) -> Column:
    """Number of maximal runs without the ASCII white space characters."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _draw(*parts: Column) -> Column:
    """Ten seeded hexadecimal digits of a key, as a number below 16**10."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 10), 16, 10).cast("long")


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: source, source_size, target, source_rank from 1."""
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*(F.lit(w) for w in mix.weights))
    ranked = total.withColumn("source_rank", F.row_number().over(order)).withColumn(
        "weight", F.element_at(weights, ((F.col("source_rank") - 1) % len(mix.weights) + 1).cast("int")).cast("double")
    )
    everything = Window.partitionBy(F.lit(1))
    cap = (mix.repeats * F.col("source_size")).cast("double")
    by_ratio = Window.partitionBy(F.lit(1)).orderBy("ratio", "source_rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levelled = (
        ranked.withColumn("cap", cap)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(mix.share))
        # the level at which this source and all with a larger ratio share what the smaller ones leave
        .withColumn(
            "level",
            (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after),
        )
        # the first source that stays below its cap sets the level for all
        .withColumn("common", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source_rank", "level"))).over(everything)["level"])
    )
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("common"), F.col("cap")))
    return levelled.select("source", "source_rank", "source_size", target.alias("target"))


def apportion(rows: DataFrame, share: str, seats: str, group: str, name: str) -> DataFrame:
    """rows with integer quotas in column name: in each group, seats by highest quotients.

    share is a weight, seats the group's number of seats (the same in its rows). With m rows
    and weights t of sum T, the winning divisor lies between T / (seats + m/2) and
    T / (seats - m/2), so only the quotients between those need to be ranked.
    """
    everything = Window.partitionBy(group)
    part = F.coalesce(F.col(share) / F.nullif(F.sum(share).over(everything), F.lit(0)), F.lit(0.0))
    half = F.count(F.lit(1)).over(everything) / 2
    held = (
        rows.withColumn("_part", part)
        .withColumn("_half", half)
        .withColumn("_low", F.greatest(F.lit(0), F.floor(F.col("_part") * (F.col(seats) - F.col("_half")) - 1)).cast("long"))
        .withColumn("_high", F.ceil(F.col("_part") * (F.col(seats) + F.col("_half")) + 1).cast("long"))
    )
    keys = [c for c in rows.columns]
    open_seats = F.col(seats) - F.col("_lows")
    ranked = (
        held.withColumn("_lows", F.sum("_low").over(everything))
        .withColumn("_k", F.explode(F.sequence(F.col("_low") + 1, F.greatest(F.col("_high"), F.col("_low") + 1))))
        .withColumn("_quotient", F.col(share) / (2 * F.col("_k") - 1))
        .withColumn("_place", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("_quotient"), "_id", "_k")))
        .withColumn("_won", ((F.col("_place") <= open_seats) & (F.col(share) > 0)).cast("long"))
    )
    return ranked.groupBy(*keys).agg((F.max("_low") + F.sum("_won")).alias(name))


def mix_sources(docs: DataFrame, mix: Mix | None = None, keep: Column | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target and taken, one row per document.

    Also how taken comes about: rounds, the times the whole document is taken, and up to two
    runs of words [from, to), counted from 0, that are taken besides. keep is a column to carry along.
    """
    mix = mix or Mix()
    nothing = F.lit(None).cast("string").alias("kept")
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")]
    # words are counted once; only a column to carry along asks for the documents again
    sizes = stored(docs.select(*columns), "sizes")
    rows = sizes.select("*", nothing) if keep is None else docs.select(*columns, keep.alias("kept"))
    salt = F.pmod(F.xxhash64("doc_id", F.lit(mix.seed)), F.lit(SALTS)).alias("_salt")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))

    # written, so that Spark knows their size when it plans the joins with them
    per_source = stored(
        targets(sizes, mix).withColumn("_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / mix.shard_words)).cast("long")), "sources"
    )

    def with_source(documents: DataFrame) -> DataFrame:
        return (
            documents.withColumn("_salt", salt)
            .alias("d")
            .join(
                per_source.withColumn("_salt", salts).withColumnRenamed("source", "_source").alias("s"),
                F.col("d.source").eqNullSafe(F.col("s._source")) & (F.col("d._salt") == F.col("s._salt")),
            )
            .drop("_salt", "_source")
            .withColumn("_shard", F.pmod(_draw(F.lit(mix.seed), F.lit("shard"), F.col("doc_id")), F.col("_shards")))
        )

    # quotas of blocks: first to sources, then to the shards of a source
    whole = F.round(F.sum("target").over(Window.partitionBy(F.lit(1))) / mix.block_words).cast("long")
    seats = apportion(
        per_source.select(F.col("source_rank").alias("_id"), "target", whole.alias("_seats"), F.lit(1).alias("_all")),
        "target", "_seats", "_all", "_quota",
    ).select(F.col("_id").alias("source_rank"), "_quota")
    shards = with_source(sizes).groupBy("source_rank", "_shard").agg(F.sum("size").alias("_shard_size")).join(seats, "source_rank")
    quotas = apportion(
        shards.select("source_rank", F.col("_shard").alias("_id"), "_shard_size", "_quota"),
        "_shard_size", "_quota", "source_rank", "_blocks",
    ).select("source_rank", F.col("_id").alias("_shard"), "_shard_size", "_blocks")

    # a ring of words: full rounds, then a run of blocks from a seeded block on
    n = F.ceil(F.col("_shard_size") / mix.block_words).cast("long")
    first = F.pmod(_draw(F.lit(mix.seed), F.lit("run"), F.col("source_rank"), F.col("_shard")), F.greatest(n, F.lit(1)))
    rings = stored(
        quotas.withColumn("_n", n)
        .withColumn("_blocks", F.least("_blocks", mix.repeats * F.col("_n")))
        .withColumn("rounds", F.when(F.col("_n") > 0, F.floor(F.col("_blocks") / F.col("_n"))).otherwise(0))
        .withColumn("_run", F.col("_blocks") - F.col("rounds") * F.col("_n"))
        .withColumn("_from", first * mix.block_words)
        .withColumn("_to", (first + F.col("_run")) * mix.block_words),
        "rings",
    ).withColumn("_salt", salts)
    order = Window.partitionBy("source_rank", "_shard").orderBy(_draw(F.lit(mix.seed), F.lit("order"), F.col("doc_id")), "doc_id", "size")
    placed = (
        with_source(rows)
        .withColumn("_end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("_salt", salt)
        .join(rings, ["source_rank", "_shard", "_salt"])
    )
    start, end = F.col("_end") - F.col("size"), F.col("_end")

    def run(low: Column, high: Column) -> Column:
        """The words of a document between two places of the ring."""
        begin, stop = F.greatest(start, low), F.least(end, high)
        return F.struct((begin - start).alias("from"), F.greatest(begin - start, stop - start).alias("to"))

    runs = F.array(run(F.col("_from"), F.col("_to")), run(F.lit(0).cast("long"), F.col("_to") - F.col("_n") * mix.block_words))
    placed = placed.withColumn("runs", F.filter(runs, lambda r: r["to"] > r["from"]))
    words = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["to"] - r["from"])
    return placed.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("rounds") * F.col("size") + words).cast("long").alias("taken"), "rounds", "runs", "kept",
    )


def mixed_rows(docs: DataFrame, columns: list[str], mix: Mix | None = None) -> DataFrame:
    """The documents of a mix: whole ones as often as the mix takes them, and the runs of words
    that it takes of a document besides. A run that is not the whole text has its words with the
    white space before each, line ends included. columns are kept; among them are text and n_chars."""
    mixed = mix_sources(docs, mix, F.struct(*columns)).where("taken > 0")
    whole = F.struct(F.lit(0).cast("long").alias("from"), F.col("size").alias("to"))
    pieces = F.concat(F.transform(F.sequence(F.lit(0), F.col("rounds").cast("int")), lambda _: whole), "runs")
    each = mixed.select("kept", "size", F.explode(F.slice(pieces, F.lit(2), F.size(pieces))).alias("piece"))
    words = F.regexp_extract_all("kept.text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    part = F.array_join(F.slice(words, (F.col("piece.from") + 1).cast("int"), (F.col("piece.to") - F.col("piece.from")).cast("int")), "")
    part = F.when(F.col("piece.from") > 0, F.ltrim(part, F.lit(" \t\n\x0b\x0c\r"))).otherwise(part)
    text = F.when((F.col("piece.from") == 0) & (F.col("piece.to") == F.col("size")), F.col("kept.text")).otherwise(part)
    rest = [F.col(f"kept.{c}").alias(c) for c in columns if c not in ("text", "n_chars")]
    out = each.select(*rest, text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 5, 2, 1 at 150 % of all words."""
    mixed = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM sizes GROUP BY source
), weighted AS (
  SELECT *, CASE (r - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w, (2 * source_size)::DOUBLE AS cap FROM totals
), levels AS (
  SELECT *, cap / w AS ratio,
    (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (ORDER BY cap / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted
), target AS (
  SELECT source, r, source_size, least(cap, coalesce(w * (SELECT arg_min(level, (ratio, r)) FROM levels WHERE level <= ratio), cap))::DOUBLE AS target FROM levels
), quotients AS (
  SELECT r, target, target / (2 * k - 1) AS quotient, k,
    row_number() OVER (ORDER BY target / (2 * k - 1) DESC, r, k) AS place
  FROM target, unnest(generate_series(1, (2 * source_size) // 16 + 2)) AS t(k) WHERE target > 0
), quotas AS (
  SELECT r, count(*) FILTER (WHERE place <= (SELECT round(sum(target) / 16) FROM target)) AS quota FROM quotients GROUP BY r
), rings AS (
  SELECT t.*, n, least(coalesce(quota, 0), 2 * n) AS blocks, ('0x' || substr(md5(concat_ws('|', 17, 'run', t.r, 0)), 1, 10))::BIGINT % greatest(n, 1) AS first
  FROM (SELECT *, ceil(source_size / 16.0)::BIGINT AS n FROM target) t LEFT JOIN quotas USING (r)
), placed AS (
  SELECT s.doc_id, s.size, g.*,
    sum(s.size) OVER (PARTITION BY g.r ORDER BY ('0x' || substr(md5(concat_ws('|', 17, 'order', s.doc_id)), 1, 10))::BIGINT, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS e
  FROM sizes s JOIN rings g ON s.source IS NOT DISTINCT FROM g.source
), runs AS (
  SELECT *, CASE WHEN n > 0 THEN blocks // n ELSE 0 END AS rounds FROM placed
), cut AS (
  SELECT *, first * 16 AS lo, (first + blocks - rounds * n) * 16 AS hi FROM runs
)
SELECT doc_id, size, source_size, target,
  (rounds * size + greatest(0, least(e, hi) - greatest(e - size, lo)) + greatest(0, least(e, hi - n * 16) - (e - size)))::BIGINT AS taken
FROM cut
"""
