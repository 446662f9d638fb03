"""Queries of projection, joining, aggregation, numbering, sorting and scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.arrays import whole_div
from millrace.functions.scalars import (
    LOG_MILLIS,
    PLAIN_ISO,
    ZONED_ISO_MILLIS,
    from_epoch_millis,
    identifier,
    parse_ts,
)
from millrace.operators import groups, joins, positions, summaries
from millrace.plans.catalogue import query, table
from millrace.plans.renderings import log_lines

SORT_LIMIT = 20_000
INDEX_RANGES = 5
# Few enough for groups to fill several arrays in small tables too.
CHUNK_ORDERS, CHUNK_CUSTOMERS, CHUNK_DAYS = 8, 1_000, 100


@query("SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice AS price FROM orders")
def select_rename(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_totalprice").alias("price"),
    )


@query("SELECT * FROM part")
def select_all(spark, sf_dir):
    return table(spark, sf_dir, "part").select("*")


@query("SELECT *, p_size * 2 AS double_size FROM part")
def computed_column(spark, sf_dir):
    return table(spark, sf_dir, "part").withColumn("double_size", F.col("p_size") * 2)


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def drop_columns(spark, sf_dir):
    return table(spark, sf_dir, "orders").drop(
        "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@query("SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000")
def filter_eq(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("large", F.col("o_totalprice") > 250_000)
    return orders.filter(F.col("o_orderstatus") == "F").filter(F.col("large")).drop("large")


@query("SELECT p_partkey FROM part WHERE p_name LIKE '%ed%'")
def filter_like(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(F.col("p_name").like("%ed%")).select("p_partkey")


@query("""
    SELECT doc_id, quality IS NULL AS unrated
    FROM documents LEFT JOIN labels USING (doc_id)
    WHERE NOT (lang IS NULL)
""")
def filter_notnull(spark, sf_dir):
    rated = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    nested = rated.select(
        "doc_id", F.struct("lang", "source").alias("meta"), F.struct("quality").alias("label")
    )
    return nested.filter(~F.isnull("meta.lang")).select(
        "doc_id", F.isnull("label.quality").alias("unrated")
    )


@query("""
    SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
""")
def equi_join(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    return joined.select("o_orderkey", "c_name", "c_mktsegment")


@query("""
    SELECT l_orderkey, l_linenumber, "key", s_name, s_nationkey
    FROM (SELECT *, CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE l_suppkey END AS "key" FROM lineitem)
    LEFT JOIN supplier ON "key" = s_suppkey
""")
def heavy_key_join(spark, sf_dir):
    """Half of the rows have one key; they go to as many tasks as their number asks for."""
    key = F.when(F.col("l_orderkey") % 2 == 0, F.lit(1)).otherwise(F.col("l_suppkey"))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", key.cast("long").alias("key"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("long").alias("key"), "s_name", "s_nationkey"
    )
    return joins.join_with_heavy_keys(items, suppliers, ["key"], "left", spread=["l_orderkey", "l_linenumber"])


@query("""
    SELECT event_id, o_orderkey
    FROM (SELECT event_id, row_number() OVER (ORDER BY event_id DESC) AS r FROM events)
    JOIN (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders) USING (r)
""")
def positional_join(spark, sf_dir):
    return positions.positional_join(
        table(spark, sf_dir, "events").select("event_id"),
        table(spark, sf_dir, "orders").select("o_orderkey"),
        [F.desc("event_id")],
        ["o_orderkey"],
    )


@query("""
    SELECT *, true AS as_many_ranges
    FROM (SELECT row_number() OVER (ORDER BY ts DESC, event_id) AS row_idx, event_id FROM events)
""")
def row_index_ranges(spark, sf_dir):
    """Numbers from a sort of a stated width, which is also the number of ranges that hold rows."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    placed, offsets = positions.place_rows(events, [F.desc("ts"), "event_id"], INDEX_RANGES)
    ranges = offsets.agg((F.count("*") == INDEX_RANGES).alias("as_many_ranges"))
    numbered = positions.numbered(placed, offsets, "row_idx", 1, ["event_id"])
    return numbered.withColumn("as_many_ranges", F.lit(ranges.first()[0]))


@query("""
    SELECT row_number() OVER (ORDER BY ts, event_id) AS row_idx, event_id FROM events
""")
def row_index(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return positions.with_row_index(events, ["ts", "event_id"]).select("row_idx", "event_id")


@query("SELECT COUNT(*) AS n_rows, COUNT(*) AS n_ids FROM lineitem")
def unique_ids(spark, sf_dir):
    """As many different ids as rows."""
    ids = table(spark, sf_dir, "lineitem").select(F.monotonically_increasing_id().alias("id"))
    return ids.agg(F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids"))


@query("SELECT COUNT(*) AS count FROM lineitem")
def count_all(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("count"))


@query("""
    SELECT l_returnflag, l_linestatus, COUNT(*) AS count
    FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def count_grouped(spark, sf_dir):
    return summaries.count_by(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


@query(f"""
    SELECT o_custkey, (r - 1) // {CHUNK_ORDERS} AS chunk,
           CAST(to_json(list(o_orderkey ORDER BY o_orderkey)) AS VARCHAR) AS orders
    FROM (SELECT o_custkey, o_orderkey,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders)
    GROUP BY o_custkey, chunk
""")
def collect_sorted(spark, sf_dir):
    lists = groups.collect_values(
        table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", CHUNK_ORDERS
    )
    return lists.select("o_custkey", "chunk", F.to_json("values").alias("orders"))


@query(f"""
    SELECT (r - 1) // {CHUNK_CUSTOMERS} AS chunk, COUNT(*) AS items, min(o_custkey) AS least,
           max(o_custkey) AS greatest, CAST(SUM(o_custkey) AS BIGINT) AS total
    FROM (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS r FROM orders)
    GROUP BY chunk
""")
def collect_whole_table(spark, sf_dir):
    """The customer of every order in arrays of a stated length, equal ones next to each other."""
    lists = groups.collect_values(
        table(spark, sf_dir, "orders"), [], "o_custkey", CHUNK_CUSTOMERS
    )
    return lists.select(
        "chunk",
        F.size("values").cast("bigint").alias("items"),
        F.array_min("values").alias("least"),
        F.array_max("values").alias("greatest"),
        F.aggregate("values", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
    )


@query(f"""
    SELECT l_suppkey, (r - 1) // {CHUNK_DAYS} AS chunk,
           CAST(to_json(list(day::VARCHAR ORDER BY day)) AS VARCHAR) AS days
    FROM (SELECT l_suppkey, day, row_number() OVER (PARTITION BY l_suppkey ORDER BY day) AS r
          FROM (SELECT DISTINCT l_suppkey, l_shipdate::DATE AS day FROM lineitem))
    GROUP BY l_suppkey, chunk
""")
def collect_distinct(spark, sf_dir):
    days = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.col("l_shipdate").cast("date").alias("day")
    )
    sets = groups.collect_distinct(days, ["l_suppkey"], "day", CHUNK_DAYS)
    texts = F.transform("values", lambda day: day.cast("string"))
    return sets.select("l_suppkey", "chunk", F.to_json(texts).alias("days"))


@query("""
    SELECT text AS longest, CAST(length(text) AS INTEGER) AS length
    FROM (SELECT text FROM documents UNION ALL SELECT source FROM documents)
    ORDER BY length(text) DESC, text DESC LIMIT 1
""")
def longest_text(spark, sf_dir):
    return summaries.longest_text(table(spark, sf_dir, "documents"), ["text", "source"])


def described_sql(name, columns):
    return " UNION ALL ".join(
        f"""
        SELECT '{c}' AS column, COUNT({c})::VARCHAR AS count,
               round(avg(TRY_CAST({c} AS DOUBLE)), 4) AS mean,
               round(stddev(TRY_CAST({c} AS DOUBLE)), 4) AS stddev,
               min({c})::VARCHAR AS min, max({c})::VARCHAR AS max
        FROM {name}
        """
        for c in columns
    )


def rounded_facts(described):
    """Means and deviations as numbers again, so that their last digits do not count."""
    return described.withColumns({
        fact: F.round(F.col(fact).cast("double"), 4) for fact in ("mean", "stddev")
    })


DESCRIBED_LINEITEM = ["l_quantity", "l_extendedprice", "l_linenumber"]
DESCRIBED_ORDERS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query(described_sql("lineitem", DESCRIBED_LINEITEM))
def describe_columns(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return rounded_facts(summaries.describe_columns(lineitem, DESCRIBED_LINEITEM))


@query(described_sql("orders", DESCRIBED_ORDERS))
def describe_texts(spark, sf_dir):
    """Text and number columns together, as a table of texts is described."""
    orders = table(spark, sf_dir, "orders")
    return rounded_facts(summaries.describe_columns(orders, DESCRIBED_ORDERS))


@query("SELECT event_type, user_id, event_id FROM events")
def sort_multi(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "user_id", "event_id")
    return events.orderBy("event_type", F.desc("user_id"), "event_id")


@query(f"""
    SELECT * FROM lineitem
    ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT {SORT_LIMIT}
""")
def sort_limit(spark, sf_dir):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return positions.sort_limit(table(spark, sf_dir, "lineitem"), order, SORT_LIMIT)


@query("SELECT o_custkey, o_orderkey FROM orders")
def sort_within(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select("o_custkey", "o_orderkey")
        .sortWithinPartitions(F.desc("o_custkey"))
    )


@query("""
    SELECT user_id, event_type, COUNT(*) AS count FROM events GROUP BY user_id, event_type
    ORDER BY count DESC, user_id, event_type LIMIT 30
""")
def topk_keys(spark, sf_dir):
    return summaries.top_counts(table(spark, sf_dir, "events"), ["user_id", "event_type"], 30)


@query(r"""
    SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host,
           regexp_extract(url, 'page=(\d+)', 1) AS page
    FROM pages
""")
def regex_group(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract("url", "^https?://([^/]+)/", 1).alias("host"),
        F.regexp_extract("url", r"page=(\d+)", 1).alias("page"),
    )


@query("""
    SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9]', '_', 'g') AS identifier FROM pages
""")
def regex_replace(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", identifier("url").alias("identifier"))


@query("""
    SELECT date_trunc('second', ts) AS captured_at, date_trunc('milliseconds', ts) AS exact,
           COUNT(*) AS count
    FROM events GROUP BY ALL
""")
def log_timestamp(spark, sf_dir):
    stamp = F.col("value").substr(2, 23)
    parsed = log_lines(table(spark, sf_dir, "events")).select(
        parse_ts(stamp, LOG_MILLIS).cast("timestamp_ntz").alias("captured_at"),
        parse_ts(stamp, LOG_MILLIS, keep_fraction=True).cast("timestamp_ntz").alias("exact"),
    )
    return summaries.count_by(parsed, ["captured_at", "exact"])


@query("""
    SELECT event_id, date_trunc('second', ts) AS plain, date_trunc('second', ts) AS zoned,
           CAST(NULL AS TIMESTAMP) AS broken
    FROM events
""")
def iso_timestamps(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    texts = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(ts, PLAIN_ISO).alias("plain"),
        F.date_format(ts, ZONED_ISO_MILLIS).alias("zoned"),
    )
    return texts.select(
        "event_id",
        parse_ts("plain", PLAIN_ISO).cast("timestamp_ntz").alias("plain"),
        parse_ts("zoned", ZONED_ISO_MILLIS).cast("timestamp_ntz").alias("zoned"),
        parse_ts(F.concat(F.lit("x"), "plain"), PLAIN_ISO).cast("timestamp_ntz").alias("broken"),
    )


@query("SELECT event_id, date_trunc('milliseconds', ts) AS time FROM events")
def millis_timestamp(spark, sf_dir):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", from_epoch_millis(millis).cast("timestamp_ntz").alias("time")
    )


@query("""
    SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_text,
           CAST(trunc(p_retailprice) AS INTEGER) AS whole_price,
           CAST(p_size AS BIGINT) // 7 AS sevenths, p_size % 7 AS rest,
           round(p_size / 7, 3) AS ratio, round(power(p_size, 0.5), 4) AS root,
           CAST(length(p_name) AS INTEGER) AS name_length,
           upper(p_name) AS upper_name, lower(p_type) AS lower_type,
           p_name || '-' || p_brand AS joined, p_size <= 25 AS small
    FROM part
""")
def casts_math(spark, sf_dir):
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        size.cast("string").cast("binary").cast("string").alias("size_text"),
        F.col("p_retailprice").cast("int").alias("whole_price"),
        whole_div(size, F.lit(7)).alias("sevenths"),
        (size % 7).alias("rest"),
        F.round(size / 7, 3).alias("ratio"),
        F.round(F.pow(size, F.lit(0.5)), 4).alias("root"),
        F.length("p_name").alias("name_length"),
        F.upper("p_name").alias("upper_name"),
        F.lower("p_type").alias("lower_type"),
        F.concat_ws("-", "p_name", "p_brand").alias("joined"),
        (size <= 25).alias("small"),
    )
