"""Joins whose keys may hold a large share of the rows, and joins of tables that lie in buckets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from millrace.operators.hashing import row_hash
from millrace.operators.layout import write_bucketed

# A right or full join would repeat unmatched rows of the repeated side.
SALTED_JOINS = ("inner", "left", "left_semi", "left_anti")


def width_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(df: DataFrame, keys: Sequence[str], width: int | None = None) -> DataFrame:
    """Keys with more rows than an even share of ``width`` partitions: ``keys`` and ``_salts``.

    ``_salts`` says over how many even shares the rows of a key go. Rows are counted before
    the shuffle, and as each such key has more than a share, there are fewer than ``width``
    of them, whatever the table; so the result may be broadcast. Null is a key like any
    other.
    """
    width = width or width_of(df.sparkSession)
    counted = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    share = df.count() / width
    found = counted.where(F.col("_rows") > share).collect()
    salts = [(*row[:-1], -int(-row["_rows"] // share)) for row in found]
    schema = counted.schema[:-1].add("_salts", IntegerType())
    return df.sparkSession.createDataFrame(salts, schema)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[key].eqNullSafe(right[key]) for key in keys])


def with_salts(df: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with ``_salts``: 1 for all but heavy keys."""
    joined = df.join(F.broadcast(heavy), same_keys(df, heavy, keys), "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce("_salts", F.lit(1)).alias("_salts"))


def salted(df: DataFrame, heavy: DataFrame, keys: Sequence[str], spread: Sequence[str] | None = None) -> DataFrame:
    """``df`` with a ``_salt`` below the number of its key's salts, from a hash of ``spread`` or of
    the whole row: a task that runs again deals its rows as before."""
    salt = F.pmod(row_hash(df, spread), F.col("_salts")).cast("int")
    return with_salts(df, heavy, keys).withColumn("_salt", salt).drop("_salts")


def repeated(df: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with its rows of heavy keys once for each ``_salt``."""
    salts = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))
    return with_salts(df, heavy, keys).withColumn("_salt", salts).drop("_salts")


def join_with_heavy_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    width: int | None = None,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """A join on equal ``keys`` whose ``left`` side may have most of its rows under few keys.

    The rows of such keys are dealt over as many salts as even shares they fill, and the right
    side's rows of these keys, and of no others, are repeated for each salt. Every left row still
    meets every right row of its key, so the result is that of the plain join; nothing is capped.
    ``spread`` names columns that tell rows of one key apart, the whole row if not given; rows
    equal in all of them stay together.

    Null keys match nothing, but a left or anti join spreads them like any heavy key. ``how`` is
    one of SALTED_JOINS; for a right join swap the sides.
    """
    if how not in SALTED_JOINS:
        raise ValueError(f"how must be one of {', '.join(SALTED_JOINS)}")
    heavy = heavy_keys(left, keys, width)
    dealt = salted(left, heavy, keys, spread)
    return dealt.join(repeated(right, heavy, keys), [*keys, "_salt"], how).drop("_salt")


def write_repeated(df: DataFrame, table: str, buckets: int, column: str, path: str, salts: int) -> None:
    """A table in buckets like those of :func:`write_bucketed`, each row once for each salt, so that
    it meets a table whose rows are dealt over that many salts."""
    copies = df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    (
        copies.hint("rebalance", column, "_salt")
        .write.format("parquet")
        .bucketBy(buckets, column, "_salt")
        .sortBy(column)
        .option("path", path)
        .saveAsTable(table)
    )


def write_for_join(
    large: DataFrame,
    large_table: str,
    large_path: str,
    other: DataFrame,
    other_table: str,
    other_path: str,
    large_column: str,
    other_column: str,
    buckets: int,
    salts: int = 1,
) -> None:
    """Two tables in equal buckets of their join columns, so that later joins move no rows.

    ``salts`` deals the rows of a key of the large table over that many buckets and repeats the
    other table as often, which pays where its keys are few or a key of the large one is heavy.
    """
    write_bucketed(large, large_table, buckets, large_column, large_path, salts)
    write_repeated(other, other_table, buckets, other_column, other_path, salts)


def join_buckets(
    spark: SparkSession, large_table: str, other_table: str, large_column: str, other_column: str, how: str = "inner"
) -> DataFrame:
    """Join of two tables of :func:`write_for_join`: bucket with bucket, without a shuffle."""
    if how not in SALTED_JOINS:
        raise ValueError(f"how must be one of {', '.join(SALTED_JOINS)}")
    large = spark.table(large_table)
    other = spark.table(other_table).withColumnRenamed("_salt", "_other_salt")
    # A merge of the buckets as they lie; broadcasting would read the other table whole everywhere.
    match = (large[large_column] == other[other_column]) & (large["_salt"] == other["_other_salt"])
    return large.hint("merge").join(other, match, how).drop("_salt", "_other_salt")
