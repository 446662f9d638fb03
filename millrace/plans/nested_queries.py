"""Queries over structs, arrays, maps and JSON text."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import jsontext, nested
from millrace.plans.catalogue import query, table


def customer_nation(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )


def nested_customers(spark, sf_dir):
    """Customers with their nation as a struct."""
    return customer_nation(spark, sf_dir).select(
        "c_custkey",
        F.struct("n_name", "n_regionkey", F.struct("c_mktsegment").alias("market")).alias("place"),
    )


@query("""
    SELECT c_custkey, n_name, n_regionkey, c_mktsegment
    FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def struct_fields(spark, sf_dir):
    return nested_customers(spark, sf_dir).select(
        "c_custkey", "place.n_name", "place.n_regionkey", "place.market.c_mktsegment"
    )


@query("""
    SELECT c_custkey, n_name, n_regionkey
    FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def struct_flatten(spark, sf_dir):
    return nested.flatten_struct(nested_customers(spark, sf_dir), "place").drop("market")


@query("""
    SELECT c_custkey, CAST(to_json({'name': c_name, 'segment': c_mktsegment}) AS VARCHAR) AS x
    FROM customer
""")
def struct_build(spark, sf_dir):
    built = F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.to_json(built).alias("x"))


@query("""
    SELECT CAST(to_json({'n_nationkey': n_nationkey, 'n_name': n_name,
                         'c_custkey': c_custkey}) AS VARCHAR) AS x
    FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def struct_nest(spark, sf_dir):
    rows = customer_nation(spark, sf_dir).select("n_nationkey", "n_name", "c_custkey")
    return nested.nest_all(rows, "x").select(F.to_json("x").alias("x"))


def order_maps(spark, sf_dir):
    """Orders with two of their columns as a map."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.create_map(
            F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority"
        ).alias("facts"),
    )


@query("""
    SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority,
           CAST(NULL AS VARCHAR) AS absent
    FROM orders
""")
def map_item(spark, sf_dir):
    return order_maps(spark, sf_dir).select(
        "o_orderkey",
        F.col("facts.status").alias("status"),
        F.col("facts").getItem("priority").alias("priority"),
        nested.entry_of("facts", "absent").alias("absent"),
    )


@query("""
    SELECT o_orderkey, 'status' AS x, o_orderstatus AS y FROM orders
    UNION ALL
    SELECT o_orderkey, 'priority' AS x, o_orderpriority AS y FROM orders
""")
def explode_map(spark, sf_dir):
    return nested.entries(order_maps(spark, sf_dir), "facts", "x", "y")


@query("""
    SELECT doc_id, words[1] AS first, words[3] AS third, CAST(len(words) AS INTEGER) AS n_words
    FROM (SELECT doc_id, string_split(text, ' ') AS words FROM documents)
""")
def array_item(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("words"))
    return words.select(
        "doc_id",
        nested.item_at("words", 0).alias("first"),
        nested.item_at("words", 2).alias("third"),
        F.size("words").alias("n_words"),
    )


@query("""
    SELECT l_orderkey, l_linenumber,
           CAST(to_json([l_partkey, l_suppkey]) AS VARCHAR) AS keys,
           CAST(to_json([[l_orderkey], [l_partkey, l_suppkey]]) AS VARCHAR) AS nested_keys
    FROM lineitem
""")
def array_build(spark, sf_dir):
    keys = F.array("l_partkey", "l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.to_json(keys).alias("keys"),
        F.to_json(F.array(F.array("l_orderkey"), keys)).alias("nested_keys"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, CAST(to_json([l_partkey, l_suppkey]) AS VARCHAR) AS b
    FROM lineitem
""")
def array_field(spark, sf_dir):
    items = F.array(
        F.struct(F.col("l_partkey").alias("b")), F.struct(F.col("l_suppkey").alias("b"))
    )
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", items.alias("a"))
    return rows.select("l_orderkey", "l_linenumber", F.to_json("a.b").alias("b"))


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def explode_array(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.explode(F.split("p_name", " ")).alias("word")
    )


@query("""
    SELECT c_custkey, concat_ws(',', n_name, c_mktsegment, coalesce(note, 'None')) AS place
    FROM (SELECT *, CASE WHEN c_acctbal < 0 THEN 'debt' END AS note
          FROM customer JOIN nation ON c_nationkey = n_nationkey)
""")
def drop_nested_items(spark, sf_dir):
    note = F.when(F.col("c_acctbal") < 0, "debt").alias("note")
    rows = customer_nation(spark, sf_dir).select(
        F.struct("n_nationkey", "n_name", "n_regionkey", "c_mktsegment", note).alias("place"),
        "c_custkey",
    )
    return nested.drop_elements(rows, 0, [0, 2], "place")


@query("""
    SELECT doc_id, array_to_string(list_filter(string_split(text, ' '),
           lambda x, i: i NOT IN (1, 3)), ',') AS words
    FROM documents
""")
def drop_array_items(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("words"))
    return nested.drop_elements(words, 1, [0, 2], "words")


@query("""
    SELECT CAST(to_json({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus,
                         'o_orderpriority': o_orderpriority}) AS VARCHAR) AS value
    FROM orders
""")
def json_encode(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return jsontext.as_message(rows)


@query("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def json_parse(spark, sf_dir):
    parsed = jsontext.parse_json(table(spark, sf_dir, "events"), "props", "k int", "json")
    return parsed.select("event_id", "json.k")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_tuple_k(spark, sf_dir):
    texts = table(spark, sf_dir, "events").select("event_id", "props")
    return jsontext.json_fields(texts, "props", ["k"])


@query("""
    SELECT event_id, user_id AS x,
           '{"z":' || json_extract_string(props, '$.k') || '}' AS y
    FROM events
""")
def json_raw_inner(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("int")
    inner = F.struct("user_id", F.struct(k.alias("z")).alias("y"))
    texts = table(spark, sf_dir, "events").select(
        "event_id", F.to_json(F.struct(inner.alias("b"))).alias("text")
    )
    schema = "b struct<user_id: bigint, y: string>"
    parsed = jsontext.parse_json(texts, "text", schema, "json")
    return parsed.select("event_id", F.col("json.b.user_id").alias("x"), "json.b.y")


@query("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           CASE WHEN event_id % 500 = 499 THEN event_id END AS late
    FROM events
""")
def json_infer(spark, sf_dir):
    """The schema comes from all messages; one field is in few of them only."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    late = F.when(F.col("event_id") % 500 == 499, F.col("event_id"))
    messages = table(spark, sf_dir, "events").select(
        "event_id", F.to_json(F.struct(k.alias("k"), late.alias("late"))).alias("text")
    )
    schema = jsontext.schema_of_messages(messages, "text")
    parsed = messages.select("event_id", F.from_json("text", schema).alias("json"))
    return parsed.select("event_id", "json.k", "json.late")
