"""Incremental ingestion of JSON files with a remembered schema."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.sources.messages import file_stream


def remembered_schema(
    spark: SparkSession,
    path: str,
    store: str,
    infer_types: bool = True,
    sampling_ratio: float = 1.0,
) -> StructType:
    """The schema kept at ``store``; the first call infers it from ``path`` and keeps it.

    Without ``infer_types`` every value is a string, which later files of
    other types cannot contradict.
    """
    try:
        kept = spark.read.text(store, wholetext=True).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = None
    if kept is not None:
        return StructType.fromJson(json.loads(kept[0]))
    reader = spark.read.option("samplingRatio", sampling_ratio)
    schema = reader.option("primitivesAsString", not infer_types).json(path).schema
    spark.createDataFrame([(schema.json(),)], "value string").write.mode("overwrite").text(store)
    return schema


# The two lineage columns, source_file and processing_time.
def with_lineage(df: DataFrame) -> DataFrame:
    """Every column, the file each row came from, and the time it was processed."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.current_timestamp().alias("processing_time"),
    )


def json_file_stream(
    spark: SparkSession,
    path: str,
    store: str,
    max_files_per_trigger: int | None = None,
    infer_types: bool = True,
) -> DataFrame:
    """New JSON files of a folder as a stream with lineage columns."""
    schema = remembered_schema(spark, path, store, infer_types)
    stream = file_stream(
        spark, path, schema, format="json", max_files_per_trigger=max_files_per_trigger
    )
    return with_lineage(stream)
