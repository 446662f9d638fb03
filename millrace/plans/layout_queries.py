"""Queries that lay a table out in files and read it back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from millrace.operators import compaction, joins, layout, lookups, sketches, versions
from millrace.plans.catalogue import query, table, table_path
from millrace.workspace import fresh_name, fresh_path

OVERWRITES = 3
SALTS = 8
LOOKUP_FILES = 32
JOIN_SALTS = 2
# Three standard errors of the catalog's estimate of different values.
DISTINCT_SHARE = 0.15
LOOKUP_GROUPS, LOOKUP_PART = 400, 77


def slots(spark):
    return spark.sparkContext.defaultParallelism


def table_bytes(spark, sf_dir, name):
    return layout.stored_bytes(spark, table_path(sf_dir, name))


def base_partitions(spark, sf_dir, name):
    """Partitions for a whole table: enough for its size, one per slot at least."""
    return layout.partition_count(table_bytes(spark, sf_dir, name), slots(spark))


def orders_with_year(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))


@query("""
    SELECT o_orderpriority, COUNT(*) AS orders FROM orders
    WHERE year(o_orderdate) = 1998 GROUP BY o_orderpriority
""")
def partitioned_scan(spark, sf_dir):
    """Only the folder of the year in question is read."""
    path = fresh_path(spark, "orders-by-year")
    layout.write_partitioned(orders_with_year(spark, sf_dir), path, ["year"])
    chosen = spark.read.parquet(path).filter(F.col("year") == 1998)
    return chosen.groupBy("o_orderpriority").agg(F.count("*").alias("orders"))


@query("""
    SELECT o_custkey, COUNT(*) AS orders, max(o_orderdate) AS last_order
    FROM orders GROUP BY o_custkey
""")
def bucketed_agg(spark, sf_dir):
    """Grouping by key and salt moves no rows; only partial results are added up by key."""
    name, path = fresh_name("orders"), fresh_path(spark, "orders-bucketed")
    buckets = layout.partition_count(
        table_bytes(spark, sf_dir, "orders"), slots(spark), layout.BUCKET_BYTES
    )
    layout.write_bucketed(
        table(spark, sf_dir, "orders"), name, buckets, "o_custkey", path, salts=SALTS
    )
    return layout.grouped_by_bucket(
        spark, name, "o_custkey",
        [F.count("*").alias("n"), F.max("o_orderdate").alias("last")],
        [F.sum("n").alias("orders"), F.max("last").alias("last_order")],
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity, o_orderdate, o_orderpriority
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def bucketed_join(spark, sf_dir):
    """Lines and their orders lie in equal buckets; the join moves no rows."""
    names = [fresh_name(name) for name in ("lineitem", "orders")]
    paths = [fresh_path(spark, f"{name}-bucketed") for name in ("lineitem", "orders")]
    buckets = layout.partition_count(table_bytes(spark, sf_dir, "lineitem"), slots(spark), layout.BUCKET_BYTES)
    joins.write_for_join(
        table(spark, sf_dir, "lineitem"), names[0], paths[0], table(spark, sf_dir, "orders"), names[1], paths[1],
        "l_orderkey", "o_orderkey", buckets, JOIN_SALTS,
    )
    joined = joins.join_buckets(spark, *names, "l_orderkey", "o_orderkey")
    return joined.select("l_orderkey", "l_linenumber", "l_quantity", "o_orderdate", "o_orderpriority")


@query("SELECT o_orderstatus, COUNT(*) AS orders FROM orders GROUP BY o_orderstatus")
def registered_files(spark, sf_dir):
    name, path = fresh_name("orders"), fresh_path(spark, "orders-by-status")
    layout.write_partitioned(table(spark, sf_dir, "orders"), path, ["o_orderstatus"])
    layout.register_files(spark, name, path)
    return spark.sql(f"SELECT o_orderstatus, COUNT(*) AS orders FROM {name} GROUP BY o_orderstatus")


def overwritten_orders(spark, sf_dir):
    """Orders written several times with different file counts; gives the table's folder."""
    root = fresh_path(spark, "orders-versions")
    orders = table(spark, sf_dir, "orders")
    files = base_partitions(spark, sf_dir, "orders")
    for more in range(OVERWRITES):
        versions.write_version(orders.repartition(files + more), root, "WRITE", ["o_orderstatus"])
    return root


@query("SELECT * FROM orders")
def repeated_overwrite(spark, sf_dir):
    """The same folder overwritten several times with different file counts."""
    path = fresh_path(spark, "orders-overwritten")
    orders = table(spark, sf_dir, "orders")
    files = base_partitions(spark, sf_dir, "orders")
    for more in range(OVERWRITES):
        orders.repartition(files + more).write.mode("overwrite").partitionBy(
            "o_orderstatus"
        ).parquet(path)
    return spark.read.parquet(path).select(orders.columns)


@query("""
    SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey BETWEEN 100 AND 199
""")
def compacted_lookup(spark, sf_dir):
    """Many small files rewritten along two columns, then a lookup on one of them."""
    root = fresh_path(spark, "orders-compacted")
    orders = table(spark, sf_dir, "orders")
    files = 2 * base_partitions(spark, sf_dir, "orders")
    versions.write_version(orders.repartition(files), root, "WRITE", ["o_orderpriority"])
    # Many files even of a small table, so that a lookup has files to skip.
    file_bytes = min(layout.FILE_BYTES, table_bytes(spark, sf_dir, "orders") // LOOKUP_FILES + 1)
    versions.optimize(spark, root, ["o_custkey", "o_orderdate"], ["o_orderpriority"], file_bytes)
    compacted = versions.read_version(spark, root).select(orders.columns)
    return compacted.filter(
        (F.col("o_orderpriority") == "1-URGENT") & F.col("o_custkey").between(100, 199)
    )


@query("SELECT * FROM lineitem")
def clustered_table(spark, sf_dir):
    """Nothing is lost when a table is rewritten in clusters."""
    path = fresh_path(spark, "lineitem-clustered")
    lineitem = table(spark, sf_dir, "lineitem")
    ranges = base_partitions(spark, sf_dir, "lineitem")
    _, rows_per_file = layout.compact_files(
        table_bytes(spark, sf_dir, "lineitem"), lineitem.count()
    )
    columns = ["l_shipdate", "l_partkey"]
    layout.compact(lineitem, path, columns, ranges, rows_per_file=rows_per_file)
    return spark.read.parquet(path)


@query("""
    SELECT v AS version, 'WRITE' AS operation, (SELECT COUNT(*) FROM orders) AS n_rows
    FROM range(0, 3) AS t(v)
    UNION ALL
    SELECT 3, 'OPTIMIZE', (SELECT COUNT(*) FROM orders)
""")
def write_history(spark, sf_dir):
    root = overwritten_orders(spark, sf_dir)
    versions.optimize(spark, root, ["o_custkey"], ["o_orderstatus"])
    return versions.history(spark, root).select("version", "operation", "n_rows")


@query("SELECT v AS version, true AS has_orphans FROM range(0, 2) AS t(v)")
def orphan_files(spark, sf_dir):
    """Files of replaced versions, per version; the live version has none."""
    root = overwritten_orders(spark, sf_dir)
    orphans = versions.orphan_files(spark, root)
    return orphans.groupBy("version").agg((F.count("*") > 0).alias("has_orphans"))


@query("""
    SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS partition, true AS has_kept,
           true AS has_orphans
    FROM orders
""")
def partition_files(spark, sf_dir):
    """Files of each partition before and after leaving out those of replaced versions."""
    root = overwritten_orders(spark, sf_dir)
    counts = versions.file_counts(spark, root)
    return counts.select(
        "partition",
        (F.col("kept") > 0).alias("has_kept"),
        (F.col("listed") > F.col("kept")).alias("has_orphans"),
    )


def stats_sql():
    """Per column: least and greatest as texts where statistics have them, nulls and different values."""
    shown = {
        "o_orderstatus": ("CAST(NULL AS VARCHAR)",) * 2, "o_orderpriority": ("CAST(NULL AS VARCHAR)",) * 2,
        "o_orderdate": ("strftime(min({0}), '%Y-%m-%d %H:%M:%S.%f')", "strftime(max({0}), '%Y-%m-%d %H:%M:%S.%f')"),
    }
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, {least} AS min, {greatest} AS max, COUNT(*) FILTER ({c} IS NULL) AS num_nulls,"
        f" COUNT(DISTINCT {c}) AS exact_distinct, true AS distinct_close FROM orders"
        for c in columns
        for least, greatest in [
            tuple(x.format(c) for x in shown.get(c, ("min({0})::VARCHAR", "max({0})::VARCHAR")))
        ]
    )


@query(stats_sql())
def column_stats(spark, sf_dir):
    """The catalog's statistics, with its estimates of different values held against exact numbers."""
    name, path = fresh_name("orders"), fresh_path(spark, "orders-analyzed")
    orders = table(spark, sf_dir, "orders")
    orders.write.option("path", path).saveAsTable(name)
    stats = layout.column_statistics(spark, name)
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in orders.columns]).unpivot(
        [], orders.columns, "col_name", "exact_distinct"
    )
    close = F.abs(F.col("distinct_count") - F.col("exact_distinct")) <= F.col("exact_distinct") * DISTINCT_SHARE
    return stats.join(exact, "col_name").select(
        "col_name", "min", "max", "num_nulls", "exact_distinct", close.alias("distinct_close")
    )


def profile(df, asked):
    skew = layout.partition_skew(df)
    return skew.select(
        (F.col("partitions") == asked).alias("as_asked"),
        "rows",
        (F.col("skew") < 1.5).alias("even"),
    )


PROFILE_SQL = "SELECT true AS as_asked, COUNT(*) AS rows, true AS even FROM lineitem"


@query(PROFILE_SQL)
def partition_profile(spark, sf_dir):
    """Repartitioning spreads rows evenly over any number of partitions."""
    asked = base_partitions(spark, sf_dir, "lineitem") + 1
    return profile(table(spark, sf_dir, "lineitem").repartition(asked), asked)


@query(PROFILE_SQL)
def coalesced_profile(spark, sf_dir):
    """Coalescing only merges: from three times as many partitions, evenly filled."""
    asked = base_partitions(spark, sf_dir, "lineitem")
    spread = table(spark, sf_dir, "lineitem").repartition(3 * asked)
    return profile(spread.coalesce(asked), asked)


@query("SELECT *, true AS packed FROM orders")
def compacted_partitions(spark, sf_dir):
    """Many small files of one partition become few; the others keep theirs."""
    path = fresh_path(spark, "orders-by-status")
    orders = table(spark, sf_dir, "orders")
    most = F.col("o_orderstatus") == "O"
    layout.write_partitioned(orders.where(~most), path, ["o_orderstatus"])
    small = orders.where(most).repartition(2 * base_partitions(spark, sf_dir, "orders"))
    small.write.mode("append").partitionBy("o_orderstatus").parquet(path)
    compaction.compact_small_files(spark, path, ["o_orderstatus"])
    stored = spark.read.parquet(path)
    files = stored.select("o_orderstatus", "_metadata.file_path", "_metadata.file_size").distinct()
    needed = files.groupBy("o_orderstatus").agg(
        (F.count("*") <= F.ceil(F.sum("file_size") / layout.FILE_BYTES) + 1).alias("packed")
    )
    return stored.join(needed, "o_orderstatus").select(*orders.columns, "packed")


@query(f"SELECT * FROM lineitem WHERE l_partkey = {LOOKUP_PART}")
def filtered_lookup(spark, sf_dir):
    """A lookup on a column that the table is not ordered by, served by Bloom filters."""
    path, lineitem = fresh_path(spark, "lineitem-filtered"), table(spark, sf_dir, "lineitem")
    # Many row groups even of a small table, so that a lookup has groups to skip.
    group_bytes = min(lookups.GROUP_BYTES, table_bytes(spark, sf_dir, "lineitem") // LOOKUP_GROUPS + 1)
    rows_per_group = lineitem.count() // LOOKUP_GROUPS + 1
    lookups.write_with_filters(
        lineitem, path, ["l_shipdate"], ["l_partkey"], slots(spark), rows_per_group, group_bytes
    )
    return spark.read.parquet(path).where(F.col("l_partkey") == LOOKUP_PART)


FACTS_SQL = """
    SELECT '{0}' AS "column", COUNT(*) AS rows, COUNT(*) FILTER ({0} IS NULL) AS nulls,
           {1} AS least, {2} AS greatest, COUNT(DISTINCT {0}) AS exact_distinct, true AS distinct_close,
           {3} AS quartiles_close
    FROM orders
"""


def facts_sql():
    micros = "CAST(epoch_us({0}(o_orderdate)) AS VARCHAR)"
    bounds = {
        "o_orderdate": (micros.format("min"), micros.format("max"), "true"),
        "o_orderpriority": ("min(o_orderpriority)", "max(o_orderpriority)", "CAST(NULL AS BOOLEAN)"),
    }
    named = lambda c: bounds.get(c, (f"CAST(min({c}) AS VARCHAR)", f"CAST(max({c}) AS VARCHAR)", "true"))
    return " UNION ALL ".join(FACTS_SQL.format(c, *named(c)) for c in FACT_COLUMNS)


FACT_COLUMNS = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(facts_sql())
def merged_statistics(spark, sf_dir):
    """Facts of each partition, sketched on their own, merged for the table, and held against exact ones."""
    orders, path = table(spark, sf_dir, "orders"), fresh_path(spark, "orders-facts")
    for status in ("O", "F", "P"):  # each partition as it arrives
        part = orders.where(F.col("o_orderstatus") == status)
        sketches.keep_facts(sketches.partition_facts(part, ["o_orderstatus"], FACT_COLUMNS), path)
    merged = sketches.merged_facts(spark.read.parquet(path)).collect()  # a row a column

    def against(row):
        measure = sketches.as_measure(orders, row["column"])
        exact = F.count_distinct(F.col(row["column"]))
        close = F.lit(None).cast("boolean")
        if measure:
            # The share of rows below, and up to, a quantile must enclose its rank.
            close = F.lit(True)
            for rank, value in zip(sketches.QUANTILES, row["quantiles"]):
                below, upto = (
                    F.avg(F.when(test, 1.0).otherwise(0.0)) for test in (measure[1] < value, measure[1] <= value)
                )
                close &= (below <= rank + sketches.RANK_ERROR) & (upto >= rank - sketches.RANK_ERROR)
        return F.struct(
            F.lit(row["column"]).alias("column"), F.lit(row["rows"]).cast("bigint").alias("rows"),
            F.lit(row["nulls"]).cast("bigint").alias("nulls"),
            F.lit(row["least"]).alias("least"), F.lit(row["greatest"]).alias("greatest"),
            exact.alias("exact_distinct"),
            (F.abs(exact - row["distinct"]) <= exact * sketches.DISTINCT_ERROR).alias("distinct_close"),
            close.alias("quartiles_close"),
        )

    checked = [orders.agg(against(row).alias("x")).select("x.*") for row in merged]
    return reduce(lambda a, b: a.unionByName(b), checked)
