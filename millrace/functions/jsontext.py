"""JSON text in and out of columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def as_message(df: DataFrame) -> DataFrame:
    """Every row as one JSON text ``value``, the shape a message sink takes."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def parse_json(df: DataFrame, column: str, schema: StructType | str, name: str) -> DataFrame:
    """A JSON text column parsed into a struct; broken text gives null fields.

    Declare an inner object as a string to keep its text as it is.
    """
    return df.withColumn(name, F.from_json(column, schema))


def parsed_rows(
    df: DataFrame, column: str, schema: str, fields: Sequence[str] | None = None
) -> DataFrame:
    """The top-level fields of a JSON text column as columns of their own.

    Each text is parsed once: the fields come out of a generator, and filters
    on them stay above it, while filters on a parsed struct would move down
    and parse again. Only ``fields`` are built when given. Broken text gives a
    row of nulls, an array one row per object.
    """
    declared = StructType.fromDDL(schema)
    wanted = StructType([declared[name] for name in fields or declared.fieldNames()])
    kept = [name for name in df.columns if name != column]
    return df.select(*kept, F.inline_outer(F.from_json(column, ArrayType(wanted))))


def json_fields(df: DataFrame, column: str, fields: Sequence[str]) -> DataFrame:
    """Named top-level fields of a JSON text column, as text."""
    kept = [name for name in df.columns if name != column]
    return df.select(*kept, F.json_tuple(column, *fields).alias(*fields))


def schema_of_messages(df: DataFrame, column: str) -> StructType:
    """The schema of all JSON objects of a text column, to hand on to ``from_json``.

    Every message is read, so a field that only few have is part of it. One row reaches the
    driver. Broken texts and nulls do not count; without any object there are no fields.
    """
    merged = df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("schema")).first()[0]
    if not merged or not merged.startswith("OBJECT"):
        return StructType([])
    # Names that are no plain words stand in backticks, and are left as they are.
    declared = re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda part: part[1] or "STRUCT<", merged)
    return StructType.fromDDL(f"j {declared}")["j"].dataType
