"""Ingestion of JSON lines whose fields come and change type.

A stream parses each line once, as a variant. Fields that the schema in force holds become
columns; what it does not hold (unknown fields, values of another type) goes as JSON text into the
column ``rescued``, and a line that is no JSON object goes whole into ``broken``. So nothing that
arrives is lost, whatever the schema knows.

Schemas have versions, kept beside the data. Each start of the ingestion looks at what was rescued
under the latest version and, if that shows new fields or types, adds a version that holds them.
Rows are stored in a folder per version, which the file sink's log covers, so each input line
counts once across restarts. A read gives the whole table under the latest version: columns of
older versions are cast, fields that were rescued come out of the rescue column, and only what even
the latest version does not hold stays there.

Types are boolean, bigint, double and string, each widened to the next that holds both: bigint and
numbers with a fraction to double, any other two to string. Objects and arrays are strings of JSON.
A null holds in any type and makes no field. Fields whose names differ only in case, or equal one of
the table's own columns, stay rescued, as do the rarest beyond ``most_fields``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from millrace.operators.layout import quoted
from millrace.sources.ingest import with_lineage
from millrace.streaming.sinks import start_files

VERSION = "schema_version"
OWN_COLUMNS = ("rescued", "broken", "source_file", "processing_time", VERSION)
MOST_FIELDS = 1_000

# Kinds of JSON values, and those that each column type holds.
HOLDS = {
    "boolean": ("BOOLEAN",),
    "bigint": ("BIGINT",),
    "double": ("BIGINT", "DECIMAL", "DOUBLE"),
    "string": ("BOOLEAN", "BIGINT", "DECIMAL", "DOUBLE", "STRING", "OBJECT", "ARRAY"),
}

Schema = dict[str, str]


def named(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def ddl(schema: Schema) -> str:
    return ", ".join(f"{named(name)} {kind}" for name, kind in schema.items())


def kind_of(value: str) -> str:
    """SQL for the kind of a variant: its type without what stands in brackets."""
    return f"regexp_extract(schema_of_variant({value}), '^[A-Z]+', 0)"


def held(schema: Schema, name: str, value: str) -> str:
    """SQL for whether a schema holds a variant under a name; nulls always hold under known names."""
    cases = [
        f"WHEN {quoted(field)} THEN {kind_of(value)} IN ({', '.join(map(quoted, ('VOID', *HOLDS[kind])))})"
        for field, kind in schema.items()
    ]
    return f"CASE {name} {' '.join(cases)} ELSE false END" if cases else "false"


def fields_of(text: str) -> Column:
    """The fields of a JSON object by name, as variants; null for any other text."""
    return F.expr(f"try_cast(try_parse_json({text}) AS map<string, variant>)")


def value_of(fields: str, name: str, kind: str) -> str:
    """SQL for a field's value if its kind is held, else null."""
    value = f"{fields}[{quoted(name)}]"
    return f"IF({held({name: kind}, quoted(name), value)}, try_variant_get({value}, '$', '{kind}'), NULL)"


def left_over(fields: str, schema: Schema) -> Column:
    """JSON text of the fields that a schema does not hold; null if it holds all."""
    rest = f"map_filter({fields}, (name, value) -> NOT ({held(schema, 'name', 'value')}))"
    return F.expr(f"IF(cardinality({rest}) > 0, to_json({rest}), NULL)")


def conformed(lines: DataFrame, schema: Schema, text: str = "value") -> DataFrame:
    """Lines as columns of ``schema``, ``rescued`` and ``broken``; other columns stay, blank lines go."""
    kept = [F.col(c) for c in lines.columns if c != text]
    parsed = lines.where(F.trim(text) != "").withColumn("_fields", fields_of(text))
    return parsed.select(
        *[F.expr(value_of("_fields", name, kind)).alias(name) for name, kind in schema.items()],
        left_over("_fields", schema).alias("rescued"),
        F.when(F.col("_fields").isNull(), F.col(text)).alias("broken"),
        *kept,
    )


def merged_type(kinds: set[str]) -> str:
    """The first column type that holds values of all kinds."""
    return next(name for name, held_kinds in HOLDS.items() if kinds <= set(held_kinds))


def widened(schema: Schema, texts: DataFrame, text: str, most_fields: int = MOST_FIELDS) -> Schema:
    """``schema`` with what the JSON objects in ``texts`` hold beyond it.

    The driver gets a row for each known field and for at most ``most_fields`` new ones, the most
    frequent first.
    """
    entries = texts.select(F.explode(F.map_entries(fields_of(text))).alias("e")).select(
        F.col("e.key").alias("name"), F.expr(kind_of("e.value")).alias("kind")
    )
    seen = entries.where("kind <> 'VOID'").groupBy("name").agg(
        F.collect_set("kind").alias("kinds"), F.count("*").alias("n")
    )
    known = F.col("name").isin(*schema) if schema else F.lit(False)
    room = max(most_fields - len(schema), 0)
    fresh = seen.where(~known).orderBy(F.desc("n"), "name").limit(room)
    made, taken = dict(schema), {name.lower() for name in (*schema, *OWN_COLUMNS)}
    for row in seen.where(known).collect():
        # The last kind of a type stands for the type itself.
        made[row["name"]] = merged_type({*row["kinds"], HOLDS[schema[row["name"]]][-1]})
    for row in sorted(fresh.collect(), key=lambda row: row["name"]):
        if row["name"].lower() not in taken:
            made[row["name"]] = merged_type(set(row["kinds"]))
            taken.add(row["name"].lower())
    return made


def schema_versions(spark: SparkSession, store: str) -> dict[int, Schema]:
    """All versions kept at ``store``."""
    try:
        rows = spark.read.schema(f"position int, name string, type string, {VERSION} int").json(store).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    versions: dict[int, Schema] = {}
    for row in sorted(rows, key=lambda row: (row[VERSION], row["position"])):
        fields = versions.setdefault(row[VERSION], {})
        if row["name"] is not None:
            fields[row["name"]] = row["type"]
    return versions


def keep_version(spark: SparkSession, store: str, version: int, schema: Schema) -> None:
    # A schema without fields leaves a row too, so that its version is known.
    rows = [(i, name, kind) for i, (name, kind) in enumerate(schema.items())] or [(0, None, None)]
    made = spark.createDataFrame(rows, "position int, name string, type string").coalesce(1)
    made.write.mode("overwrite").json(f"{store}/{VERSION}={version}")


def stored_version(spark: SparkSession, target: str, version: int, schema: Schema) -> DataFrame:
    """The rows stored under one version, with its columns."""
    own = f"rescued string, broken string, source_file string, processing_time timestamp, {VERSION} int"
    columns = f"{ddl(schema)}, {own}" if schema else own
    return spark.read.schema(columns).parquet(target).where(F.col(VERSION) == version)


def current_schema(spark: SparkSession, path: str, target: str, store: str, most_fields: int) -> tuple[int, Schema]:
    """The version for the next run: the latest, or a new one where it did not hold everything."""
    versions = schema_versions(spark, store)
    if not versions:
        version, schema = 1, widened({}, spark.read.text(path), "value", most_fields)
        keep_version(spark, store, version, schema)
        return version, schema
    version = max(versions)
    try:
        rescued = stored_version(spark, target, version, versions[version]).where("rescued IS NOT NULL")
        schema = widened(versions[version], rescued, "rescued", most_fields)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return version, versions[version]
    if schema != versions[version]:
        version += 1
        keep_version(spark, store, version, schema)
    return version, schema


def start_ingest(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    store: str,
    most_fields: int = MOST_FIELDS,
    every: str | None = None,
) -> StreamingQuery:
    """Take new files of JSON lines below ``path`` in, under the schema that holds what came so far."""
    version, schema = current_schema(spark, path, target, store, most_fields)
    lines = with_lineage(spark.readStream.text(path))
    rows = conformed(lines, schema).withColumn(VERSION, F.lit(version))
    return start_files(rows, target, checkpoint, partition_by=[VERSION], every=every)


def read_ingested(spark: SparkSession, target: str, store: str) -> DataFrame:
    """All rows under the latest version of the schema."""
    versions = schema_versions(spark, store)
    latest = versions[max(versions)]
    parts = []
    for version, schema in versions.items():
        rows = stored_version(spark, target, version, schema)
        if schema != latest:
            rows = rows.withColumn("_fields", fields_of("rescued"))
            rows = rows.select(
                *[
                    F.coalesce(
                        (F.col(named(name)) if name in schema else F.lit(None)).cast(kind),
                        F.expr(value_of("_fields", name, kind)),
                    ).alias(name)
                    for name, kind in latest.items()
                ],
                left_over("_fields", latest).alias("rescued"),
                *OWN_COLUMNS[1:],
            )
        parts.append(rows.select(*map(named, latest), *OWN_COLUMNS))
    made = parts[0]
    for part in parts[1:]:
        made = made.unionAll(part)
    return made
