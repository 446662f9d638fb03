"""Queries that read each kind of source."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.jsontext import as_message
from millrace.functions.scalars import PLAIN_ISO, parse_ts
from millrace.operators.groups import collect_values
from millrace.operators.layout import cached, cached_bytes, partition_count
from millrace.plans.catalogue import query, table
from millrace.plans.renderings import envelopes, page_view_rows
from millrace.sources import files, messages, rows
from millrace.streaming.sinks import run_to_table
from millrace.workspace import fresh_name, fresh_path, materialize

ORDERS = """
    o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
    o_orderdate timestamp_ntz, o_orderpriority string
"""
DOCUMENT_ORDERS = 4_000
PAGE_VIEWS = "timestamp string, site string, requests int"


def orders_as_csv(spark, sf_dir, **options):
    path = fresh_path(spark, "orders-csv")
    table(spark, sf_dir, "orders").write.options(header=True, **options).csv(path)
    return path


def orders_as_json(spark, sf_dir):
    path = fresh_path(spark, "orders-json")
    table(spark, sf_dir, "orders").write.json(path)
    return path


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
           o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS o_orderdate, o_orderpriority
    FROM orders
""")
def csv_all_strings(spark, sf_dir):
    return files.read_csv_text(spark, orders_as_csv(spark, sf_dir))


@query("""
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
           o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
           CASE WHEN (SELECT max(o_orderkey) FROM orders) < 2147483648 THEN 'int' ELSE 'bigint' END
               || ',' || CASE WHEN (SELECT max(o_custkey) FROM orders) < 2147483648 THEN 'int' ELSE 'bigint' END
               || ',string,double,timestamp,string' AS inferred
    FROM orders
""")
def csv_inferred(spark, sf_dir):
    df = files.read_csv_inferred(spark, orders_as_csv(spark, sf_dir))
    inferred = ",".join(kind for _, kind in df.dtypes)
    # Inference gives the narrowest type that fits; widen to what the table has.
    return df.withColumns({
        "o_orderkey": F.col("o_orderkey").cast("bigint"),
        "o_custkey": F.col("o_custkey").cast("bigint"),
        "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz"),
        "inferred": F.lit(inferred),
    })


@query("SELECT * FROM orders")
def tsv_declared_gzip(spark, sf_dir):
    path = orders_as_csv(spark, sf_dir, sep="\t", compression="gzip")
    return files.read_delimited(spark, path, ORDERS)


@query("SELECT * FROM orders")
def json_lines(spark, sf_dir):
    return files.read_json_lines(spark, orders_as_json(spark, sf_dir), ORDERS)


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS o_orderdate, o_orderpriority,
           'bigint,string,bigint,string,string,double' AS inferred
    FROM orders
""")
def json_lines_inferred(spark, sf_dir):
    """Fields and their types come from the texts; names are sorted."""
    df = files.read_json_lines(spark, orders_as_json(spark, sf_dir))
    inferred = ",".join(dict(df.dtypes)[name] for name in sorted(df.columns))
    return df.withColumn("inferred", F.lit(inferred))


@query("SELECT * FROM orders")
def json_multiline(spark, sf_dir):
    # One document of a stated number of orders per file, so that files stay moderate.
    texts = as_message(table(spark, sf_dir, "orders"))
    documents = collect_values(texts, [], "value", DOCUMENT_ORDERS)
    path = fresh_path(spark, "orders-documents")
    document = F.concat(F.lit("[\n"), F.array_join("values", ",\n"), F.lit("\n]"))
    documents.select(document.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return files.read_json_documents(spark, path, ORDERS)


@query("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
    UNION ALL
    SELECT event_id, event_id AS k FROM events
""")
def json_text_to_rows(spark, sf_dir):
    own = F.to_json(F.struct(F.col("event_id").alias("k")))
    texts = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("["), "props", F.lit(","), own, F.lit("]")).alias("text")
    )
    return rows.explode_json(texts, "text", "k bigint")


@query("""
    SELECT event_id AS key, 5 AS items, true AS in_range, true AS nested_same, true AS same_again
    FROM events
""")
def generated_arrays(spark, sf_dir):
    """Seeded numbers: their range, their two shapes, and the same ones from other partitions."""
    events = table(spark, sf_dir, "events")
    made = rows.generated_arrays(events, "event_id")
    again = rows.generated_arrays(events.repartition(3), "event_id")
    both = made.join(again.select("key", F.col("values").alias("again")), "key")
    return both.select(
        "key",
        F.size("values").alias("items"),
        F.forall("values", lambda x: (x >= 0) & (x < 100)).alias("in_range"),
        (F.flatten("nested_values") == F.col("values")).alias("nested_same"),
        (F.col("again") == F.col("values")).alias("same_again"),
    )


@query("""
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open'
           END AS meaning
    FROM orders
""")
def local_rows(spark, sf_dir):
    meanings = rows.local_rows(
        spark,
        [("F", "finished"), ("O", "open")],
        "o_orderstatus string, meaning string",
    )
    # Two rows written above; orders of any other status keep a null.
    joined = table(spark, sf_dir, "orders").join(F.broadcast(meanings), "o_orderstatus", "left")
    return joined.select("o_orderkey", "meaning")


@query("SELECT o_orderpriority, COUNT(*) AS orders FROM orders GROUP BY o_orderpriority")
def catalog_read(spark, sf_dir):
    name = fresh_name("orders")
    path = fresh_path(spark, "catalog")
    table(spark, sf_dir, "orders").write.option("path", path).saveAsTable(name)
    return spark.sql(
        f"SELECT o_orderpriority, COUNT(*) AS orders FROM {name} GROUP BY o_orderpriority"
    )


def replayed(spark, sf_dir, **topics):
    path = fresh_path(spark, "messages")
    table(spark, sf_dir, "events").transform(envelopes).write.parquet(path)
    # A few files per slot and batch.
    throttle = 4 * spark.sparkContext.defaultParallelism
    stream = messages.replay_messages(spark, path, max_files_per_trigger=throttle, **topics)
    kept = stream.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )
    return run_to_table(kept).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


ENVELOPE_SQL = """
    SELECT CAST(user_id AS VARCHAR) AS key, props AS value, event_type AS topic,
           CAST(event_id % 4 AS INTEGER) AS partition, event_id AS offset, ts AS timestamp
    FROM events
"""


@query(ENVELOPE_SQL + " WHERE event_type IN ('click', 'view')")
def message_replay(spark, sf_dir):
    return replayed(spark, sf_dir, subscribe="click, view")


@query(ENVELOPE_SQL + """
    WHERE (event_type = 'click' AND event_id % 4 IN (1, 3))
       OR (event_type = 'error' AND event_id % 4 = 2)
""")
def message_replay_assigned(spark, sf_dir):
    return replayed(spark, sf_dir, assign={"click": [1, 3], "error": [2]})


@query(ENVELOPE_SQL + " WHERE regexp_full_match(event_type, '(view|s.*)')")
def message_replay_pattern(spark, sf_dir):
    return replayed(spark, sf_dir, subscribe_pattern="view|s.*")


@query("""
    SELECT date_trunc('second', ts) AS created_at, event_type AS site,
           CAST(floor(value) AS INTEGER) AS requests
    FROM events
""")
def page_views(spark, sf_dir):
    """Zipped text read with a declared schema, spread over the slots, times parsed, cached."""
    path = fresh_path(spark, "page-views")
    page_view_rows(table(spark, sf_dir, "events")).write.options(
        header=True, sep="\t", compression="gzip"
    ).csv(path)
    # The text's size in memory says how many partitions it needs.
    texts = cached(files.read_delimited(spark, path, PAGE_VIEWS))
    partitions = partition_count(cached_bytes(texts), spark.sparkContext.defaultParallelism)
    parsed = texts.repartition(partitions).select(
        parse_ts("timestamp", PLAIN_ISO).cast("timestamp_ntz").alias("created_at"),
        "site",
        "requests",
    )
    views = cached(parsed)
    texts.unpersist()
    stored = materialize(views, "page-views")
    views.unpersist()
    return stored
