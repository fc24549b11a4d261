"""File listings: which files belong to a source, and how many to read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GB = 1_000_000_000


def is_source_file(name: Column) -> Column:
    """Data files have no dot in their base name and are no folder markers."""
    return ~name.contains(".") & ~name.endswith("_$folder$")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length`` of every source file below ``path``, at any depth.

    Contents are never read: the scan's schema holds file metadata only. Spark
    leaves out empty files, which hold no cells, and names that start with ``_``
    or a dot, folders included.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"))
    )
    return files.filter(is_source_file(F.substring_index("path", "/", -1)))


def largest_first(files: DataFrame) -> DataFrame:
    return files.orderBy(F.col("length").desc(), F.col("path"))


def _folder_and_name(path: Column) -> tuple[Column, Column]:
    name = F.substring_index(path, "/", -1)
    folder = F.substring(path, F.lit(1), F.length(path) - F.length(name))
    return folder, name


def within_budget(files: DataFrame, limit_bytes: int) -> DataFrame:
    """Files up to and including the one that crosses ``limit_bytes``; 0 keeps all.

    Files count in folder-and-name order. The running total is taken over one
    row per folder first and then inside each folder, so no task sees the whole
    listing.
    """
    if limit_bytes <= 0:
        return files
    folder, name = _folder_and_name(F.col("path"))
    files = files.withColumn("_folder", folder).withColumn("_name", name)
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    folders = files.groupBy("_folder").agg(F.sum("length").alias("_bytes"))
    folders = folders.select(
        "_folder",
        F.coalesce(F.sum("_bytes").over(before.orderBy("_folder")), F.lit(0)).alias("_folder_start"),
    )
    in_folder = before.partitionBy("_folder").orderBy("_name")
    # Folders that start beyond the budget drop out before the second window.
    return (
        files.join(folders.filter(F.col("_folder_start") <= limit_bytes), "_folder")
        .withColumn("_start", F.col("_folder_start") + F.coalesce(F.sum("length").over(in_folder), F.lit(0)))
        .filter(F.col("_start") <= limit_bytes)
        .select("path", "length")
    )


def budget_predicate(files: DataFrame, limit_bytes: int, path: Column) -> Column:
    """Predicate on a file path that holds for the files within the budget.

    The kept files are a prefix of the folder-and-name order, so the last one
    stands for them all: one row comes back to the driver, however long the list.
    """
    folder, name = _folder_and_name(F.col("path"))
    last = within_budget(files, limit_bytes).agg(F.max(F.struct(folder.alias("f"), name.alias("n"))).alias("m"))
    last = last.first()["m"]
    if last is None:
        return F.lit(False)
    folder, name = _folder_and_name(path)
    return (folder < last["f"]) | ((folder == last["f"]) & (name <= last["n"]))
