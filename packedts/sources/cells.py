"""Cell and point tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packedts.schemas import CELLS
from packedts.sources.files import GB, budget_predicate, is_source_file


def read_cells(
    spark: SparkSession,
    path: str | list[str],
    *,
    format: str = "parquet",
    limit_gb: int = 0,
    bare_names_only: bool = False,
    ignore_missing: bool = True,
    tag_file: bool = True,
) -> DataFrame:
    """One row per stored cell, tagged with its ``file``.

    ``bare_names_only`` applies the archive's naming rule (no dot in the file
    name, no folder markers); leave it off for tables written by Spark, whose
    file names carry an extension. Both that rule and the size budget are
    predicates on file metadata, so skipped files are never opened. Files that
    vanish between listing and reading are passed over, as on a live store.
    """
    reader = (
        spark.read.schema(CELLS)
        .option("recursiveFileLookup", "true")
        .option("ignoreMissingFiles", str(ignore_missing).lower())
    )
    cells = reader.format(format).load(path)
    file_path = F.col("_metadata.file_path")
    if bare_names_only:
        cells = cells.filter(is_source_file(F.col("_metadata.file_name")))
    if limit_gb > 0:
        listing = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(path)
            .select(file_path.alias("path"), F.col("_metadata.file_size").alias("length"))
        )
        if bare_names_only:
            listing = listing.filter(is_source_file(F.substring_index("path", "/", -1)))
        cells = cells.filter(budget_predicate(listing, limit_gb * GB, file_path))
    return cells.withColumn("file", file_path) if tag_file else cells


def read_points(spark: SparkSession, table: str) -> DataFrame:
    """An imported table, by path or by catalog name."""
    return spark.read.parquet(table) if "/" in table else spark.read.table(table)
