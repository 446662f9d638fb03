"""Reductions and rewrites of array columns, all inside one narrow stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_div(a: Column, b: Column) -> Column:
    """Whole-number division that truncates toward zero and is null for a zero divisor."""
    return F.call_function("div", a, F.nullif(b, F.lit(0)))


def add_inside(nested: ColumnOrName, amount: Column) -> Column:
    """Every number of an array of arrays, plus ``amount`` and its inner array's length."""
    return F.transform(
        as_column(nested),
        lambda inner: F.transform(inner, lambda x: x + amount + F.size(inner)),
    )


def array_sum(values: ColumnOrName, finish: Callable[[Column], Column] | None = None) -> Column:
    """Sum of whole numbers; null when an item is null, zero for an empty array."""
    start = F.lit(0).cast("bigint")
    add = lambda total, x: total + x
    if finish is None:
        return F.aggregate(as_column(values), start, add)
    return F.aggregate(as_column(values), start, add, finish)


def array_mean(
    values: ColumnOrName, finish: Callable[[Column], Column] | None = None
) -> Column:
    """Truncated average of whole numbers; null for an empty array."""
    array = as_column(values)

    def average(total: Column) -> Column:
        mean = whole_div(total, F.size(array))
        return mean if finish is None else finish(mean)

    return array_sum(array, average)


def to_fahrenheit(celsius: Column) -> Column:
    """Whole degrees, multiplied before the truncating division."""
    return whole_div(celsius * 9, F.lit(5)) + 32


def geometric_mean(values: ColumnOrName) -> Column:
    """Geometric mean by a running product and count.

    The product of a long array leaves the range of a double; use
    :func:`log_geometric_mean` for those.
    """
    start = F.struct(F.lit(1.0).alias("product"), F.lit(0).alias("n"))
    return F.aggregate(
        as_column(values),
        start,
        lambda acc, x: F.struct(
            (acc["product"] * x).alias("product"), (acc["n"] + 1).alias("n")
        ),
        lambda acc: F.pow(acc["product"], F.lit(1.0) / F.nullif(acc["n"], F.lit(0))),
    )


def log_geometric_mean(values: ColumnOrName) -> Column:
    """Geometric mean of positive numbers by their logarithms, for arrays of any length."""
    array = as_column(values)
    return F.aggregate(
        array,
        F.lit(0.0),
        lambda total, x: total + F.ln(x),
        lambda total: F.exp(total / F.nullif(F.size(array), F.lit(0))),
    )


def euclidean_norm(values: ColumnOrName) -> Column:
    """Square root of the sum of squares."""
    return F.aggregate(
        as_column(values),
        F.lit(0.0),
        lambda total, x: total + x.cast("double") * x.cast("double"),
        F.sqrt,
    )
