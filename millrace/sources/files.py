"""Batch readers for delimited text, JSON files and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    sep: str = "\t",
    partitions: int | None = None,
) -> DataFrame:
    """Delimited text with a header and a declared schema; gzip is recognised by name.

    A gzip file cannot be split, so each one arrives as a single partition.
    Give ``partitions`` to spread the rows again before heavy work.
    """
    df = spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)
    return df.repartition(partitions) if partitions else df


def read_csv_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """CSV with a header; column types come from an extra pass over the text."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("samplingRatio", sampling_ratio)
        .csv(path)
    )


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column a string; costs no inference pass."""
    return spark.read.csv(path, header=True)


def read_json_lines(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """A directory with one JSON object per line."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def read_json_documents(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """Files that each hold one JSON document over several lines.

    Such a file is parsed by one task, so keep single files to a moderate size
    and let their number grow with the data.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("multiLine", True).json(path)
