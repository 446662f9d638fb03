"""Tables for point lookups on columns that their order does not serve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from millrace.operators.layout import clustered

GROUP_BYTES = 128 * 1024 * 1024
FALSE_HITS = 0.01


def write_with_filters(
    df: DataFrame,
    path: str,
    order_by: Sequence[str],
    filtered: Sequence[str],
    ranges: int,
    rows_per_group: int,
    group_bytes: int = GROUP_BYTES,
) -> None:
    """Write Parquet ordered by some columns, with Bloom filters on others.

    Ranges of ``order_by`` are skipped by least and greatest values. A value of a ``filtered``
    column may lie in any range, so its row groups are told by a filter of about ten bits a row,
    read before the rows; one in a hundred others passes it. Filters are sized for
    ``rows_per_group`` different values. Groups that hold few different values list them in a
    dictionary instead, which serves the same lookups.
    """
    writer = clustered(df, order_by, ranges).write.option("parquet.block.size", group_bytes)
    for column in filtered:
        writer = (
            writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{column}", rows_per_group)
            .option(f"parquet.bloom.filter.fpp#{column}", FALSE_HITS)
        )
    # Groups close by size, which is looked at every so many rows.
    writer.option("parquet.page.size.row.check.min", min(100, rows_per_group)).option(
        "parquet.block.size.row.check.min", min(100, rows_per_group)
    ).option("parquet.block.size.row.check.max", max(100, rows_per_group)).parquet(path)


def rows_scanned(df: DataFrame) -> int:
    """Rows that the scans of a collected table have read: those of row groups that were not skipped."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
