"""Collecting the values of groups as sorted arrays of a stated length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.positions import in_ranges
from millrace.workspace import materialize


def carries(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_part``, ``_first`` and ``_before``: what the first group of each range has in earlier ranges.

    Ranges are sorted by key, so no other group of a range can start before it. There is one row
    for each range, however many groups there are.
    """
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    edges = placed.groupBy("_part").agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    last = placed.join(edges.select("_part", "_last"), "_part").where(key.eqNullSafe(F.col("_last")))
    # The last group of a range may go on in later ones; the first asks what came before.
    ends = last.groupBy("_part", F.col("_last").alias("_key")).agg(F.sum("_n").alias("_sum"))
    marks = ends.select("_part", "_key", F.lit(1).alias("_end"), "_sum").unionByName(
        edges.select("_part", F.col("_first").alias("_key"), F.lit(0).alias("_end"), F.lit(0).cast("bigint").alias("_sum"))
    )
    earlier = W.partitionBy("_key").orderBy("_part", "_end").rowsBetween(W.unboundedPreceding, -1)
    found = marks.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    return found.where(F.col("_end") == 0).select("_part", F.col("_key").alias("_first"), "_before")


def with_start(counted: DataFrame, keys: Sequence[str], value: str, ranges: int | None) -> DataFrame:
    """Add ``_start``: how many values of the same group come before each value's first.

    ``counted`` has one row for each different value of a group, with its number in ``_n``,
    so a value that fills a group is a single row. Rows are stored in ranges of key and
    value; one small row a range says how far its first group has come before it.
    """
    placed = materialize(
        in_ranges(counted, [*keys, value], ranges).withColumn("_part", F.spark_partition_id()), "values"
    )
    inside = W.partitionBy("_part", *keys).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    local = placed.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    before = F.when(key.eqNullSafe(F.col("_first")), F.col("_before")).otherwise(0)
    return local.join(carries(placed, keys), "_part").select(
        *keys, value, "_n", (before + F.col("_inside")).alias("_start")
    )


def in_chunks(
    counted: DataFrame, keys: Sequence[str], value: str, items: int, ranges: int | None
) -> DataFrame:
    placed = with_start(counted, keys, value, ranges)
    end = F.col("_start") + F.col("_n")
    chunks = F.sequence(F.expr(f"_start div {items}"), F.expr(f"(_start + _n - 1) div {items}"))
    pieces = placed.withColumn("chunk", F.explode(chunks)).withColumn(
        "_here",
        F.least(end, (F.col("chunk") + 1) * items) - F.greatest("_start", F.col("chunk") * items),
    )
    repeated = F.transform(
        F.sort_array(F.collect_list(F.struct(F.col(value).alias("v"), F.col("_here").cast("int").alias("n")))),
        lambda x: F.array_repeat(x["v"], x["n"]),
    )
    return pieces.groupBy(*keys, "chunk").agg(F.flatten(repeated).alias("values"))


def collect_values(
    df: DataFrame, keys: Sequence[str], value: str, items: int, ranges: int | None = None
) -> DataFrame:
    """The values of each group in sorted arrays: ``keys``, ``chunk``, ``values``.

    Chunk 0 holds the first ``items`` values of the group, chunk 1 the next, and so on, so
    the arrays of a group end to end are its sorted values, and none is longer than
    ``items``, however large the group is. No keys means the whole table. Nulls are left
    out. Equal values are counted before the shuffle. ``ranges`` is the width of the sort,
    the session's if not given.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return in_chunks(counted, keys, value, items, ranges)


def collect_distinct(
    df: DataFrame, keys: Sequence[str], value: str, items: int, ranges: int | None = None
) -> DataFrame:
    """The distinct values of each group, shaped as in :func:`collect_values`."""
    pairs = df.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    return in_chunks(pairs.withColumn("_n", F.lit(1).cast("bigint")), keys, value, items, ranges)
