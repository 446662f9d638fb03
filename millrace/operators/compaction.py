"""Packing small files of a partitioned table, and only where there are some."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.layout import FILE_BYTES, stored_files
from millrace.operators.positions import with_row_index
from millrace.workspace import materialize, settings


def plain_path(path: Column) -> Column:
    """A path with single slashes behind the scheme of local files."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def read_path() -> Column:
    """The file that a row was read from, spelled like the listing does: readers give it as a URI."""
    return plain_path(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """``folder``, ``file`` and ``length`` of each file of a table."""
    file = plain_path(F.col("path"))
    return stored_files(spark, path).select(
        F.regexp_extract(file, "^(.*)/[^/]*$", 1).alias("folder"), file.alias("file"), "length"
    )


def crowded_folders(files: DataFrame, target_bytes: int) -> DataFrame:
    """Folders that have small files and more files than their size asks for."""
    return (
        files.groupBy("folder")
        .agg(
            F.count("*").alias("files"),
            F.ceil(F.sum("length") / target_bytes).alias("needed"),
            F.count_if(F.col("length") < target_bytes / 2).alias("small"),
        )
        .where("small > 1 AND files > needed")
    )


def packed(files: DataFrame, target_bytes: int) -> DataFrame:
    """``file`` and ``task``: files of a folder in stretches of about the target size, numbered over
    all folders."""
    before = F.sum("length").over(
        W.partitionBy("folder").orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    )
    stretch = F.floor(F.coalesce(before, F.lit(0)) / target_bytes)
    placed = materialize(files.withColumn("stretch", stretch), "packed-files")
    numbers = with_row_index(
        placed.select("folder", "stretch").distinct(), ["folder", "stretch"], name="task", start=0
    )
    return placed.join(numbers, ["folder", "stretch"]).select("file", F.col("task").cast("int").alias("task"))


def compact_small_files(
    spark: SparkSession, path: str, partition_by: Sequence[str], target_bytes: int = FILE_BYTES
) -> int:
    """Rewrite the partitions of a Parquet table that hold small files; gives their number.

    Whole files are packed, in the order of their names, into tasks of about the target size, and
    each task writes one file. Only partitions named by the listing are read and overwritten, all
    others keep their files. The rows of a partition come from its own files, so none moves to
    another. One writer at a time: a file that is added meanwhile makes the job fail before it
    overwrites; if the driver is lost while Spark swaps folders, the packed files are in its
    staging folder.
    """
    files = materialize(listed_files(spark, path), "listing")
    chosen = crowded_folders(files, target_bytes)
    folders = sorted(row["folder"] for row in chosen.select("folder").collect())
    if not folders:
        return 0
    tasks = materialize(packed(files.join(chosen.select("folder"), "folder", "left_semi"), target_bytes), "packing")
    # As texts, partition values name the same folders again ("01" would come back as 1).
    with settings(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        rows = spark.read.option("basePath", path).parquet(*folders)
    names = rows.columns
    marked = rows.withColumn("file", read_path()).join(tasks, "file", "left")
    # A file that came after the listing would be lost with its folder.
    task = F.coalesce("task", F.raise_error(F.concat(F.lit("not listed: "), "file")).cast("int"))
    dealt = marked.repartitionById(tasks.agg(F.max("task")).first()[0] + 1, task)
    (
        dealt.select(*names)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return len(folders)
