"""How tables lie in files and partitions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from millrace.operators.hashing import row_hash

# Fixed value: advised size of a cached partition.
PARTITION_BYTES = 200 * 1024 * 1024
FILE_BYTES = 256 * 1024 * 1024
BUCKET_BYTES = 1024 * 1024 * 1024
SAMPLE_ROWS = 10_000
# Types that Spark takes percentiles of.
CUT_TYPES = (NumericType, DateType, TimestampType, TimestampNTZType)


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``length`` of every file below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files below a folder."""
    return stored_files(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def partition_count(total_bytes: int, slots: int, target_bytes: int = PARTITION_BYTES) -> int:
    """As few partitions as the target size allows, but one per slot at least."""
    return max(slots, math.ceil(total_bytes / target_bytes))


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition: ``partition``, ``rows``. Empty partitions do not show."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count("*").alias("rows")
    )


def partition_skew(df: DataFrame) -> DataFrame:
    """Number of filled partitions, their rows in all, and the largest against the mean."""
    return partition_profile(df).agg(
        F.count("*").alias("partitions"),
        F.sum("rows").alias("rows"),
        F.max("rows").alias("largest"),
        (F.max("rows") / F.avg("rows")).alias("skew"),
    )


def write_partitioned(
    df: DataFrame, path: str, columns: Sequence[str], mode: str = "errorifexists"
) -> None:
    """One folder per value of ``columns``.

    The rebalance hint gathers each value's rows so that small ones get one
    file, and splits the partitions of large ones at the advisory size.
    """
    df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(path)


def write_bucketed(
    df: DataFrame,
    table: str,
    buckets: int,
    column: str,
    path: str,
    salts: int = 1,
    mode: str = "errorifexists",
) -> None:
    """A catalog table bucketed by ``column`` and ``_salt``, sorted inside its buckets.

    A bucketed scan gives each bucket to one task. The salt, a hash of the row below
    ``salts``, deals a key over up to that many buckets.
    """
    salted = df.withColumn("_salt", F.pmod(row_hash(df), F.lit(salts)).cast("int"))
    (
        salted.hint("rebalance", column, "_salt")
        .write.format("parquet")
        .mode(mode)
        .bucketBy(buckets, column, "_salt")
        .sortBy(column)
        .option("path", path)
        .saveAsTable(table)
    )


def grouped_by_bucket(
    spark: SparkSession, table: str, column: str, partial: Sequence[Column], final: Sequence[Column]
) -> DataFrame:
    """Group a table of :func:`write_bucketed` by its key.

    ``partial`` aggregates within key and salt, where no row moves; ``final`` adds up the
    partial results by key, at most one row per key and salt.
    """
    parts = spark.table(table).groupBy(column, "_salt").agg(*partial)
    return parts.groupBy(column).agg(*final)


def register_files(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Make a catalog table of the Parquet files at ``path``, replacing one of that name."""
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType == "MANAGED":
            raise ValueError(f"{table} owns its files; drop it yourself to replace it")
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION {quoted(path)}")
    partitioned = any(column.isPartition for column in spark.catalog.listColumns(table))
    if partitioned:
        spark.catalog.recoverPartitions(table)
    return spark.table(table)


def discard(df: DataFrame) -> None:
    """Run the whole plan and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def cached(df: DataFrame) -> DataFrame:
    """Cache the table and fill the cache; ``unpersist()`` of the result frees it."""
    df.cache()
    df.count()
    return df


def cached_bytes(df: DataFrame) -> int:
    """Size in memory of a table that :func:`cached` filled, from its plan's statistics."""
    statistics = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(statistics.sizeInBytes()))


def column_statistics(spark: SparkSession, table: str) -> DataFrame:
    """Compute statistics of all columns; one row per column.

    ``min`` and ``max`` are texts and stay null for columns that have none.
    """
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    facts = ["col_name", "data_type", "min", "max", "num_nulls", "distinct_count"]
    described = [
        spark.sql(f"DESCRIBE EXTENDED {table} `{column}`")
        .filter(F.col("info_name").isin(facts))
        .agg(*[
            F.max(F.when(F.col("info_name") == fact, F.col("info_value"))).alias(fact)
            for fact in facts
        ])
        for column in spark.table(table).columns
    ]
    rows = reduce(DataFrame.unionAll, described)
    absent = lambda c: F.when(F.col(c) != "NULL", F.col(c))
    return rows.select(
        "col_name",
        "data_type",
        absent("min").alias("min"),
        absent("max").alias("max"),
        F.col("num_nulls").cast("bigint").alias("num_nulls"),
        F.col("distinct_count").cast("bigint").alias("distinct_count"),
    )


def cut_points(df: DataFrame, columns: Sequence[str], cells: int) -> list[list]:
    """For each column at most ``cells - 1`` values that cut it into about equal parts.

    Numbers and times are cut at approximate percentiles of all rows, in one pass; other
    types at those of a sample of about ``SAMPLE_ROWS`` rows. Cuts steer where rows lie,
    never which rows.
    """
    shares = [i / cells for i in range(1, cells)]
    measured = [c for c in columns if isinstance(df.schema[c].dataType, CUT_TYPES)]
    found = {}
    if measured and shares:
        accuracy = max(10_000, 10 * cells)
        row = df.agg(*[F.percentile_approx(c, shares, accuracy).alias(c) for c in measured]).first()
        found = {c: row[c] or [] for c in measured}
    others = [c for c in columns if c not in found]
    if others:
        fraction = min(1.0, SAMPLE_ROWS / max(df.count(), 1))
        sample = df.select(*others).sample(fraction, seed=17).collect()
        for column in others:
            values = sorted(row[column] for row in sample if row[column] is not None)
            picked = [values[len(values) * i // cells] for i in range(1, cells) if values]
            found[column] = [value for value in picked if value != values[0]]
    return [sorted(set(found[column])) for column in columns]


def spread_bits(number: int, stride: int) -> int:
    """The bits of ``number``, each followed by ``stride - 1`` zero bits."""
    return sum(
        1 << (bit * stride) for bit in range(number.bit_length()) if number >> bit & 1
    )


def quoted(value) -> str:
    """A value as SQL text."""
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def curve_column(df: DataFrame, columns: Sequence[str], bits: int) -> Column:
    """Z-order position of each row: its cell numbers, one per column, with bits interleaved.

    Each column is cut into at most ``2 ** bits`` cells; nulls lie in the first.
    Fewer cells are numbered with gaps, so that every column counts in the
    leading bits.
    """
    last = 2**bits - 1
    types = dict(df.dtypes)
    position = F.lit(0).cast("bigint")
    for index, (column, cuts) in enumerate(zip(columns, cut_points(df, columns, 2**bits))):

        def tree(low: int, high: int) -> str:
            """SQL that halves the cells from ``low`` to ``high`` until one is left.

            SQL text, because a Column call per cut makes building the plan slow.
            """
            if low == high:
                cell = last * low // len(cuts)
                return f"{spread_bits(cell, len(columns)) << index}L"
            middle = (low + high) // 2  # noqa: B023
            test = f"`{column}` >= CAST({quoted(cuts[middle])} AS {types[column]})"
            return f"IF({test}, {tree(middle + 1, high)}, {tree(low, middle)})"

        if cuts:
            position = position + F.coalesce(F.expr(tree(0, len(cuts))), F.lit(0))
    return position


def curve_bits(ranges: int, columns: int) -> int:
    """Cells per column, as bits, so that there are a few times as many cells as ranges."""
    return max(5, math.ceil(math.log2(max(ranges, 2)) / columns) + 1)


def clustered(
    df: DataFrame,
    columns: Sequence[str],
    ranges: int,
    partition_by: Sequence[str] = (),
    bits: int | None = None,
) -> DataFrame:
    """Rows in ``ranges`` partitions, close values of ``columns`` together, sorted inside each.

    One column is ordered by value. Several are ordered along the Z-order
    curve, whose position is computed once per row, not at every comparison. A
    hash of the whole row ends the range key, so that even equal values are
    spread over several ranges when there are too many for one.
    """
    marks = {"_spread": row_hash(df)}
    if len(columns) > 1:
        marks["_curve"] = curve_column(df, columns, bits or curve_bits(ranges, len(columns)))
    key = [*partition_by, *(name for name in marks if name == "_curve"), *columns]
    return (
        df.withColumns(marks)
        .repartitionByRange(ranges, *key, "_spread")
        .sortWithinPartitions(*key)
        .drop(*marks)
    )


def compact(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str],
    ranges: int,
    partition_by: Sequence[str] = (),
    rows_per_file: int = 0,
) -> None:
    """Rewrite a table into few files whose value ranges hardly overlap.

    A lookup on the cluster columns then skips most files and row groups by
    their least and greatest values. A range with more than ``rows_per_file``
    rows is cut into several files, each a stretch of the sorted rows; 0 sets
    no limit.
    """
    writer = clustered(df, cluster_by, ranges, partition_by).write
    writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def compact_files(total_bytes: int, rows: int, target_bytes: int = FILE_BYTES) -> tuple[int, int]:
    """Number of ranges, and rows per file, for files of about the target size."""
    files = max(1, math.ceil(total_bytes / target_bytes))
    return files, math.ceil(rows / files)
