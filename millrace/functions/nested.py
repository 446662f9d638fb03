"""Helpers for structs, arrays and maps."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def flatten_struct(df: DataFrame, column: str) -> DataFrame:
    """The fields of a struct as columns, next to the other columns."""
    kept = [name for name in df.columns if name != column]
    return df.select(*kept, f"{column}.*")


def nest_all(df: DataFrame, name: str) -> DataFrame:
    """All columns inside one struct."""
    return df.select(F.struct("*").alias(name))


def item_at(array: Column | str, index: int) -> Column:
    """Array item by position from 0; null outside the array."""
    return F.get(array, F.lit(index))


def entry_of(map_column: Column | str, key: str) -> Column:
    """Map value by key; null when the key is missing."""
    return F.try_element_at(map_column, F.lit(key))


def entries(df: DataFrame, column: str, key: str = "key", value: str = "value") -> DataFrame:
    """One row per map entry, next to the other columns."""
    kept = [name for name in df.columns if name != column]
    return df.select(*kept, F.explode(column).alias(key, value))


def item_text(item: Column, null_text: str) -> Column:
    return F.coalesce(item.cast("string"), F.lit(null_text))


def drop_elements(
    df: DataFrame,
    field_number: int,
    drop_fields: Collection[int],
    column_name: str,
    null_text: str = "None",
) -> DataFrame:
    """Join the items of a nested column as text, leaving out some positions.

    ``field_number`` picks a struct or array column by position. Its items,
    without those at ``drop_fields``, are joined by commas, a null item written
    as ``null_text``. The column named ``column_name`` goes and the text takes
    its name at the end. A null nested value gives null.
    """
    field = df.schema.fields[field_number]
    nested = df[field.name]
    if isinstance(field.dataType, StructType):
        names = field.dataType.fieldNames()
        items = [
            item_text(nested[name], null_text)
            for position, name in enumerate(names)
            if position not in drop_fields
        ]
        joined = F.concat_ws(",", *items) if items else F.lit("")
    elif isinstance(field.dataType, ArrayType):
        dropped = [F.lit(position) for position in sorted(drop_fields)]
        kept = F.filter(nested, lambda _, i: ~i.isin(dropped)) if dropped else nested
        joined = F.array_join(F.transform(kept, lambda x: item_text(x, null_text)), ",")
    else:
        raise ValueError(f"column {field_number} ({field.name}) is neither struct nor array")
    text = F.when(nested.isNotNull(), joined)
    others = [df[name] for name in df.columns if name != column_name]
    return df.select(*others, text.alias(column_name))
