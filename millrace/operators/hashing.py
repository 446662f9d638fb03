"""A hash of rows that is the same in every run of a task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Hash of the given columns, or of the whole row.

    It tells rows with equal keys apart, so that they can be spread. Unlike a
    random number or a running id it depends on the row alone: a task that runs
    again sends each row where it went before.
    """
    types = dict(df.dtypes)
    return F.xxhash64(*[
        F.to_json(F.struct(name)) if "map<" in types[name] else F.col(name)
        for name in columns or df.columns
    ])
