"""The corpus pipeline: toxicity, near duplicates, personal data, mix of sources, packing.

Every stage takes the documents that the one before it kept and returns documents; the last one
returns the pieces of the packed sequences. Stages look at the columns of the documents table
only, so other columns may hold anything.

Defined results: null and empty texts pass the first three stages as they are and hold no
words for the mix, which leaves them out; of rows with equal doc_id and text the first by lang, source and
n_chars stays, and texts that share a doc_id are documents of their own; of near duplicates the least doc_id stays,
one without doc_id only if none has any; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packedts.llm.mixing import mixed_rows
from packedts.llm.packing import added_tokens, byte_bpe, pack
from packedts.llm.surrogates import with_surrogates
from packedts.llm.tensor_minhash import near_duplicates
from packedts.llm.toxicity import learn, scores
from packedts.scratch import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REJECT_FROM = 0.5
SURROGATE_KEY = b"a key for the registered pipeline; a real run passes its own"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below REJECT_FROM; the model is learned from the labels table."""
    docs = docs.select(*COLUMNS)
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scores(docs, model, *COLUMNS).where(F.col("score") < REJECT_FROM).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates (5-word shingles, 0.8) the document with the least doc_id.

    A document is a (doc_id, text), by a 64-bit hash: texts that share a doc_id are judged one by one.
    """
    docs = docs.select(*COLUMNS).withColumn("_key", F.xxhash64("doc_id", "text"))
    # exact copies first, in part before any shuffle
    one = F.row_number().over(Window.partitionBy("_key").orderBy("lang", "source", "n_chars"))
    docs = docs.withColumn("_copy", one).where("_copy = 1").drop("_copy")
    groups = near_duplicates(docs.select(F.col("_key").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("_key"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_key")).alias("first")
    stay = docs.select("doc_id", "_key").join(groups, "_key").groupBy("component_id").agg(first)
    return docs.join(stay.select("first._key"), "_key", "left_semi").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in place of personal data."""
    replaced = with_surrogates(docs.select(*COLUMNS), SURROGATE_KEY)
    return replaced.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the amounts that the target weights give their sources."""
    return mixed_rows(docs.select(*COLUMNS), COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of sequences of at most 2048 tokens, with their ids."""
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return pack(docs, lambda: byte_bpe(ranks, pattern, added))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix", mix),
    ("packing", packing),
]

ORACLE_SQL = None  # tokenizing, hashing and learning have no SQL; the tests hold each stage against a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
