"""Row numbers over a whole table, side-by-side joins, and large sorted prefixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.hashing import row_hash
from millrace.workspace import materialize, settings

# monotonically_increasing_id keeps the position within a partition below this bit.
POSITION_BITS = 33

# Up to this many rows a limit after a sort is merged from one short list per task.
SHORT_LIMIT = 1_000
# Up to this rank Spark cuts the rows of a task before the shuffle of a ranking.
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def in_ranges(df: DataFrame, order: Sequence[Column | str], ranges: int | None) -> DataFrame:
    """Globally sorted rows in ``ranges`` partitions, or as many as the session's width."""
    if ranges is None:
        return df.orderBy(*order)
    return df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)


def place_rows(
    df: DataFrame, order_by: Sequence[Column | str] | None, ranges: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The stored rows with their partition and position, and each partition's offset."""
    # The hash lets rows that tie in the order fall into several ranges.
    ordered = in_ranges(df, [*order_by, row_hash(df)], ranges) if order_by else df
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    placed = materialize(
        ordered.withColumns({"_part": F.spark_partition_id(), "_pos": within}), "placed-rows"
    )
    # One row per partition, so the window over all of them stays small.
    before = F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", "_rows", F.coalesce(before, F.lit(0)).alias("_before"))
    )
    return placed, offsets


def numbered(
    placed: DataFrame, offsets: DataFrame, name: str, start: int, columns: Sequence[str]
) -> DataFrame:
    joined = placed.join(offsets, "_part")
    index = F.col("_before") + F.col("_pos") + F.lit(start)
    return joined.select(*columns, index.cast("bigint").alias(name))


def with_row_index(
    df: DataFrame,
    order_by: Sequence[Column | str] | None = None,
    name: str = "row_idx",
    start: int = 1,
    ranges: int | None = None,
) -> DataFrame:
    """Consecutive row numbers without moving the table into one partition.

    Rows are numbered in the given order, or else as they lie in their
    partitions. They are written to the shared folder together with partition
    and position, so every later pass sees the same numbers, also where the
    order has ties.
    """
    placed, offsets = place_rows(df, order_by, ranges)
    return numbered(placed, offsets, name, start, df.columns)


def stored_rows(offsets: DataFrame) -> int:
    return offsets.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]


def positional_join(
    left: DataFrame,
    right: DataFrame,
    left_order: Sequence[Column | str] | None = None,
    right_order: Sequence[Column | str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Two tables side by side: first row with first row, and so on to the shorter end.

    The row counts of both are known once they are placed, so the rows of the longer table
    beyond the shorter one's end are left out before the join.
    """
    sides = [place_rows(left, left_order, ranges), place_rows(right, right_order, ranges)]
    rows = min(stored_rows(offsets) for _, offsets in sides)
    first, second = (
        numbered(placed.join(offsets.where(F.col("_before") < rows).select("_part"), "_part", "left_semi"),
                 offsets, "_row", 0, df.columns).where(F.col("_row") < rows)
        for df, (placed, offsets) in zip((left, right), sides)
    )
    return first.join(second, "_row").drop("_row")


def first_of_each_task(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Of each input partition the first ``n`` rows, which hold the first ``n`` of all.

    Under GROUP_LIMIT a task cuts its rows before they are shuffled.
    """
    rank = F.row_number().over(W.partitionBy("_task").orderBy(*order, row_hash(df)))
    ranked = df.withColumn("_task", F.spark_partition_id()).withColumn("_rank", rank)
    return ranked.where(F.col("_rank") <= n).select(*df.columns)


def sort_limit(
    df: DataFrame,
    order_by: Sequence[str],
    n: int,
    ascending: bool | Sequence[bool] = True,
    ranges: int | None = None,
    short: int = SHORT_LIMIT,
) -> DataFrame:
    """The first ``n`` rows of the sorted table.

    Up to ``short`` rows this is a top-k; a longer prefix would pass every task's first
    ``n`` rows through a single task, so each task keeps its own first ``n``, and these are
    numbered in sorted ranges and kept up to ``n``. Both orders end in the same hash of the
    row, so ``short`` decides how the rows are found and never which.
    """
    ups = [ascending] * len(order_by) if isinstance(ascending, bool) else list(ascending)
    order = [F.asc(c) if up else F.desc(c) for c, up in zip(order_by, ups, strict=True)]
    if n <= short:
        return df.orderBy(*order, row_hash(df)).limit(n)
    with settings(df.sparkSession, {GROUP_LIMIT: str(n + 1)}):
        placed, offsets = place_rows(first_of_each_task(df, order, n), order, ranges)
    last = offsets.filter(F.col("_before") < n).agg(F.max("_part")).first()[0]
    needed = placed.filter(F.col("_part") <= F.lit(last if last is not None else -1))
    kept = numbered(needed, offsets, "_row", 0, df.columns).filter(F.col("_row") < n)
    return kept.orderBy("_row").drop("_row")
