"""Tables from JSON text, from local rows, and from generated values."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

def explode_json(df: DataFrame, column: str, schema: StructType | str) -> DataFrame:
    """One row per object in a JSON text column, next to the other columns.

    The text holds one object or an array of objects. Text that does not parse
    gives no row.
    """
    if isinstance(schema, DataType):
        parsed = F.from_json(column, ArrayType(schema))
    else:
        parsed = F.from_json(column, f"array<struct<{schema}>>")
    kept = [name for name in df.columns if name != column]
    return df.select(*kept, F.inline(parsed))


def json_to_df(
    spark: SparkSession, text: str, schema: StructType | str | None = None
) -> DataFrame:
    """A table from one JSON text: a single object, or an array with one row each."""
    df = spark.createDataFrame([(text,)], "value string")
    if schema is not None:
        return explode_json(df, "value", schema)
    inferred = F.from_json("value", F.schema_of_json(F.lit(text)))
    parsed = df.select(inferred.alias("value"))
    if isinstance(parsed.schema["value"].dataType, ArrayType):
        return parsed.select(F.inline("value"))
    return parsed.select("value.*")


def local_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """A small table from rows held by the caller."""
    return spark.createDataFrame(list(rows), schema)


def seeded_fraction(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on ``key`` and ``seed`` only.

    ``rand(seed)`` changes with the partitioning; a hash does not, so a task that
    runs again gives the same value.
    """
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) / F.lit(float(1 << 53))


def generated_arrays(
    ids: DataFrame,
    key: str,
    seeds: Sequence[int] = (1, 2, 3, 4, 5),
    split_at: int = 2,
    bound: int = 100,
) -> DataFrame:
    """``key``, an array of seeded whole numbers, and the same numbers in two inner arrays."""
    numbers = [
        (seeded_fraction(F.col(key), seed) * bound).cast("int") for seed in seeds
    ]
    return ids.select(
        F.col(key).alias("key"),
        F.array(*numbers).alias("values"),
        F.array(F.array(*numbers[:split_at]), F.array(*numbers[split_at:])).alias("nested_values"),
    )
