"""Tables kept as numbered versions, with a history and a search for leftover files.

A write goes to a folder of its own and counts once its history row is
appended; a failed write leaves only files that the search reports. There is
one writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.layout import (
    FILE_BYTES,
    clustered,
    compact_files,
    stored_files,
)

HISTORY = (
    "version bigint, committed_at timestamp, operation string, "
    "n_files bigint, n_bytes bigint, n_rows bigint"
)


def version_path(root: str, version: int) -> str:
    return f"{root}/data/version={version}"


def history(spark: SparkSession, root: str) -> DataFrame:
    """One row per finished write."""
    try:
        return spark.read.schema(HISTORY).parquet(f"{root}/history")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], HISTORY)


def live_version(spark: SparkSession, root: str) -> int | None:
    """The last finished version; None before the first write."""
    return history(spark, root).agg(F.max("version")).first()[0]


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of a version, the last one unless given."""
    chosen = live_version(spark, root) if version is None else version
    if chosen is None:
        raise ValueError(f"nothing has been written to {root}")
    return spark.read.parquet(version_path(root, chosen))


def write_version(
    df: DataFrame,
    root: str,
    operation: str,
    partition_by: Sequence[str] = (),
    rows_per_file: int = 0,
) -> int:
    """Write the next version of a table and record it; gives the version number."""
    spark = df.sparkSession
    last = live_version(spark, root)
    version = 0 if last is None else last + 1
    path = version_path(root, version)
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # Counted in the file footers, so that the history tells what is really there.
    n_rows = spark.read.schema(df.schema).parquet(path).count()
    facts = stored_files(spark, path).agg(
        F.lit(version).cast("bigint").alias("version"),
        F.current_timestamp().alias("committed_at"),
        F.lit(operation).alias("operation"),
        F.count("*").alias("n_files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"),
        F.lit(n_rows).cast("bigint").alias("n_rows"),
    )
    facts.coalesce(1).write.mode("append").parquet(f"{root}/history")
    return version


def optimize(
    spark: SparkSession,
    root: str,
    cluster_by: Sequence[str],
    partition_by: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
) -> int:
    """Write the live version again in clustered files of about the given size."""
    df = read_version(spark, root)
    live = history(spark, root).orderBy(F.desc("version")).first()
    ranges, rows_per_file = compact_files(live["n_bytes"], live["n_rows"], file_bytes)
    return write_version(
        clustered(df, cluster_by, ranges, partition_by),
        root,
        "OPTIMIZE",
        partition_by,
        rows_per_file,
    )


def kept_versions(spark: SparkSession, root: str, retain_hours: float) -> DataFrame:
    """The live version and those replaced within the last ``retain_hours``."""
    # The history has one row per write, so this window is small.
    replaced = F.lead("committed_at").over(W.orderBy("version"))
    age = F.current_timestamp().cast("double") - F.col("replaced_at").cast("double")
    return (
        history(spark, root)
        .withColumn("replaced_at", replaced)
        .filter(F.col("replaced_at").isNull() | (age < retain_hours * 3600))
        .select("version")
    )


def table_files(spark: SparkSession, root: str) -> DataFrame:
    """Every data file with its version."""
    version = F.regexp_extract("path", r"/data/version=(\d+)/", 1).cast("bigint")
    return stored_files(spark, f"{root}/data").withColumn("version", version)


def file_counts(spark: SparkSession, root: str, retain_hours: float = 0) -> DataFrame:
    """Files per partition folder: all that are ``listed``, and those a kept version holds."""
    kept = kept_versions(spark, root, retain_hours).withColumn("is_kept", F.lit(1))
    folder = F.regexp_extract("path", r"/data/version=\d+/(.*/|)[^/]*$", 1)
    return (
        table_files(spark, root)
        .join(kept, "version", "left")
        .groupBy(F.rtrim(folder, F.lit("/")).alias("partition"))
        .agg(F.count("*").alias("listed"), F.count("is_kept").alias("kept"))
    )


def orphan_files(spark: SparkSession, root: str, retain_hours: float = 0) -> DataFrame:
    """Data files that no kept version holds: ``path``, ``length``, ``version``.

    They are listed for an operator to remove; nothing is deleted here.
    """
    return table_files(spark, root).join(
        kept_versions(spark, root, retain_hours), "version", "left_anti"
    ).select("path", "length", "version")
