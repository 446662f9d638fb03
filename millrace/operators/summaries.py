"""One-pass summaries of a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def longest_text(
    df: DataFrame, columns: Sequence[str] | None = None, null_text: str = "None"
) -> DataFrame:
    """The longest text among the given columns, as ``longest`` and ``length``.

    Of several equally long texts the greatest one is taken, so the result does
    not depend on the row order.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(null_text)) for c in columns or df.columns]
    candidates = [F.struct(F.length(t).alias("length"), t.alias("longest")) for t in texts]
    in_row = F.greatest(*candidates) if len(candidates) > 1 else candidates[0]
    return df.agg(F.max(in_row).alias("best")).select("best.longest", "best.length")


def describe_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, least and greatest value of number and text columns, one row each.

    All facts are texts, so that whole numbers stay exact. The mean and the deviation of a
    text column are those of its texts that are numbers, null if none is. A table without
    such columns gives no row.
    """
    names = columns or [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, (NumericType, StringType))
    ]
    names = list(names)

    def facts(name: str):
        number = F.col(name).try_cast("double")
        return F.struct(
            F.lit(name).alias("column"),
            F.count(name).cast("string").alias("count"),
            F.avg(number).cast("string").alias("mean"),
            F.stddev(number).cast("string").alias("stddev"),
            F.min(name).cast("string").alias("min"),
            F.max(name).cast("string").alias("max"),
        ).alias(name)

    if not names:
        kinds = ", ".join(f"{c} string" for c in ("column", "count", "mean", "stddev", "min", "max"))
        return df.sparkSession.createDataFrame([], kinds)
    one_row = df.agg(*[facts(name) for name in names])
    return one_row.select(F.inline(F.array(*[F.col(name) for name in names])))


def count_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def top_counts(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most frequent keys; equal counts are ordered by key."""
    return count_by(df, keys).orderBy(F.desc("count"), *keys).limit(k)

