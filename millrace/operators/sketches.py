"""Column statistics that are kept per partition and merged for the table.

A partition's facts are one row a column: rows, nulls, a HyperLogLog sketch of its different values
and, for numbers and times, a KLL sketch of their order. Sketches of partitions merge into the
sketch of the table, so a new partition costs a scan of its own rows only, and asking costs a read
of the stored facts.

Counts, least and greatest values are exact. Distinct counts are within DISTINCT_ERROR and ranks of
quantiles within RANK_ERROR, each about three of the sketch's standard errors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HLL_BITS = 12
KLL_SIZE = 400
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.02
QUANTILES = (0.25, 0.5, 0.75)

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTION = (T.FloatType, T.DoubleType, T.DecimalType)


def as_measure(df: DataFrame, name: str) -> tuple[str, Column] | None:
    """Kind of the order sketch and the value it takes; None for columns without one."""
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, WHOLE):
        return "bigint", column.cast("bigint")
    if isinstance(kind, FRACTION):
        return "double", column.cast("double")
    if isinstance(kind, T.DateType):
        return "bigint", F.unix_date(column).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "bigint", F.unix_micros(column.cast("timestamp"))
    return None


def partition_facts(df: DataFrame, partition_by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row for each partition and column, in one pass over the rows.

    ``least`` and ``greatest`` are kept for texts; those of measures are in their sketch.
    """

    def facts(name: str) -> Column:
        measure = as_measure(df, name)
        text = F.col(name).cast("string")
        sketch = {"bigint": F.lit(None).cast("binary"), "double": F.lit(None).cast("binary")}
        if measure:
            kind, value = measure
            sketch[kind] = F.call_function(f"kll_sketch_agg_{kind}", value, F.lit(KLL_SIZE))
        return F.struct(
            F.lit(name).alias("column"),
            F.count("*").alias("rows"),
            F.count_if(F.col(name).isNull()).alias("nulls"),
            (F.lit(None).cast("string") if measure else F.min(text)).alias("least"),
            (F.lit(None).cast("string") if measure else F.max(text)).alias("greatest"),
            F.hll_sketch_agg(text, F.lit(HLL_BITS)).alias("values"),
            sketch["bigint"].alias("whole"),
            sketch["double"].alias("fraction"),
        )

    gathered = df.groupBy(*partition_by).agg(F.array(*map(facts, columns)).alias("facts"))
    return gathered.select(*partition_by, F.inline("facts"))


def keep_facts(facts: DataFrame, path: str) -> None:
    """Add the facts of new partitions to those kept."""
    facts.write.mode("append").parquet(path)


def merged_facts(kept: DataFrame) -> DataFrame:
    """Facts of the whole table: a row a column, from the kept rows alone.

    ``least``, ``greatest`` and the quantiles of times are microseconds, those of dates days.
    """

    def measures(kind: str, column: str) -> DataFrame:
        get = lambda rank: F.call_function(f"kll_sketch_get_quantile_{kind}", "sketch", F.lit(float(rank)))
        merged = kept.where(F.col(column).isNotNull()).groupBy("column").agg(
            F.call_function(f"kll_merge_agg_{kind}", column).alias("sketch")
        )
        filled = merged.where(F.call_function(f"kll_sketch_get_n_{kind}", "sketch") > 0)
        return filled.select(
            "column",
            get(0).cast("string").alias("first"),
            get(1).cast("string").alias("last"),
            F.array(*[get(rank).cast("double") for rank in QUANTILES]).alias("quantiles"),
        )

    ordered = measures("bigint", "whole").unionByName(measures("double", "fraction"))
    counted = kept.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("distinct"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
    )
    return counted.join(ordered, "column", "left").select(
        "column", "rows", "nulls", "distinct",
        F.coalesce("least", "first").alias("least"), F.coalesce("greatest", "last").alias("greatest"), "quantiles",
    )

