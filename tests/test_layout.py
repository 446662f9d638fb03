"""Files, partitions, versions and statistics."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import layout, versions
from millrace.workspace import fresh_name, fresh_path, settings, shared_folder


def parquet_files(path):
    path = path.removeprefix("file:")
    return sorted(
        os.path.join(folder, name)
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sales(spark):
    """Half of all rows in one country."""
    country = F.when(F.col("id") % 2 == 0, "Sweden").otherwise(
        F.concat(F.lit("C"), (F.col("id") % 5).cast("string"))
    )
    return spark.range(20_000).select(
        country.alias("country"), (F.col("id") * 37 % 500).alias("code"), "id"
    )


def same_rows(a, b):
    b = b.select(a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_partitioned_write_prunes(spark, sales):
    path = fresh_path(spark, "t")
    layout.write_partitioned(sales, path, ["country"])
    assert len(parquet_files(path)) == 6
    back = spark.read.parquet(path)
    assert same_rows(sales, back)
    chosen = back.filter(F.col("country") == "Sweden")
    assert "country" in plan_of(chosen).split("PartitionFilters: [")[1].split("]")[0]


def test_large_partition_value_gets_several_files(spark, sales):
    path = fresh_path(spark, "t")
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB"}):
        layout.write_partitioned(sales.repartition(8), path, ["country"])
    swedish = [name for name in parquet_files(path) if "Sweden" in name]
    assert len(swedish) > 1
    assert same_rows(sales, spark.read.parquet(path))


@pytest.mark.parametrize("salts", [1, 5])
def test_bucketed_aggregate_moves_partial_results_only(spark, salts):
    """Half of all rows have one key; its rows lie in several buckets."""
    code = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 500)
    df = spark.range(20_000).select(code.alias("code"), "id")
    name, path = fresh_name("t"), fresh_path(spark, "t")
    layout.write_bucketed(df, name, 8, "code", path, salts=salts)
    counted = layout.grouped_by_bucket(
        spark, name, "code", [F.count("*").alias("n")], [F.sum("n").alias("count")]
    )
    assert same_rows(df.groupBy("code").count(), counted)
    partial = spark.table(name).groupBy("code", "_salt").count()
    assert "Exchange" not in plan_of(partial)
    assert plan_of(counted).count("Exchange hashpartitioning") == 1
    hot = [r["count"] for r in partial.where("code = 0").collect()]
    assert len(hot) == salts and max(hot) < 2 * sum(hot) / salts


def test_register_files_replaces(spark, sales):
    name = fresh_name("t")
    for part in (sales.filter("id < 10"), sales):
        path = fresh_path(spark, "t")
        layout.write_partitioned(part, path, ["country"])
        assert same_rows(part, layout.register_files(spark, name, path))
    plain = fresh_path(spark, "t")
    sales.write.parquet(plain)
    assert same_rows(sales, layout.register_files(spark, name, plain))


@pytest.mark.parametrize("columns", [["code"], ["code", "id"], ["country", "code", "id"]])
def test_compaction_keeps_rows_and_narrows_files(spark, sales, columns):
    path = fresh_path(spark, "t")
    layout.compact(sales.repartition(40), path, columns, ranges=8)
    back = spark.read.parquet(path)
    assert same_rows(sales, back)
    files = back.groupBy(F.col("_metadata.file_path")).agg(
        *[F.min(c).alias(f"min_{c}") for c in columns],
        *[F.max(c).alias(f"max_{c}") for c in columns],
    )
    assert 6 <= files.count() <= 8
    wanted = sales.filter("id = 12345").first()
    for column in columns:
        touched = files.filter(
            (F.col(f"min_{column}") <= wanted[column]) & (F.col(f"max_{column}") >= wanted[column])
        )
        assert touched.count() < files.count()


@pytest.mark.parametrize("lookup", ["a", "b"])
def test_lookup_on_each_cluster_column_touches_few_of_many_files(spark, lookup):
    df = spark.range(50_000).select(
        (F.col("id") * 7919 % 50_000).alias("a"), (F.col("id") * 104_729 % 49_999).alias("b")
    )
    path = fresh_path(spark, "t")
    layout.compact(df, path, ["a", "b"], ranges=64)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(
        F.min(lookup).alias("least"), F.max(lookup).alias("most")
    )
    assert files.count() >= 60
    assert files.where("least <= 20000 and most >= 20000").count() <= files.count() / 4


def test_register_files_spares_managed_tables(spark, sales):
    name = fresh_name("t")
    sales.limit(5).write.saveAsTable(name)
    with pytest.raises(ValueError):
        layout.register_files(spark, name, fresh_path(spark, "t"))
    assert spark.table(name).count() == 5
    path = fresh_path(spark, "it's")
    sales.limit(7).write.parquet(path)
    assert layout.register_files(spark, fresh_name("t"), path).count() == 7


def test_compaction_splits_equal_values(spark):
    """One value everywhere still spreads over the files."""
    df = spark.range(8000).select(F.lit(1).alias("code"), "id")
    sizes = layout.partition_profile(layout.clustered(df, ["code"], 8)).collect()
    assert len(sizes) == 8 and max(r["rows"] for r in sizes) < 2000


def test_clustering_takes_awkward_values(spark):
    rows = [("it's", None), ("back\\slash", 1.5), (None, -2.0), ("zażółć", 3.25)] * 5
    df = spark.createDataFrame(rows, "t string, x double")
    assert same_rows(df, layout.clustered(df, ["t", "x"], 3))
    empty = df.filter("x > 100")
    assert layout.clustered(empty, ["t", "x"], 3).count() == 0


def test_spread_bits():
    assert [layout.spread_bits(n, 2) for n in (0, 1, 2, 3, 4)] == [0, 1, 4, 5, 16]
    assert layout.spread_bits(3, 3) == 9


def test_versions_history_and_orphans(spark, sales):
    root = fresh_path(spark, "t")
    assert versions.live_version(spark, root) is None
    with pytest.raises(ValueError):
        versions.read_version(spark, root)
    for files in (3, 4, 5):
        versions.write_version(sales.repartition(files), root, "WRITE", ["country"])
    assert versions.optimize(spark, root, ["code"], ["country"]) == 3
    assert same_rows(sales, versions.read_version(spark, root))
    assert same_rows(sales, versions.read_version(spark, root, 0))

    log = versions.history(spark, root).orderBy("version").collect()
    assert [(r["version"], r["operation"], r["n_rows"]) for r in log] == [
        (0, "WRITE", 20_000), (1, "WRITE", 20_000), (2, "WRITE", 20_000), (3, "OPTIMIZE", 20_000)
    ]
    assert [r["n_files"] for r in log[:3]] == [18, 24, 30]
    assert log[3]["n_files"] == 6
    assert [r["committed_at"] for r in log] == sorted(r["committed_at"] for r in log)

    orphans = versions.orphan_files(spark, root).collect()
    assert len(orphans) == 18 + 24 + 30
    assert {r["version"] for r in orphans} == {0, 1, 2}
    on_disk = {"file:" + name for name in parquet_files(root + "/data")}
    assert {r["path"] for r in orphans} < on_disk
    assert versions.orphan_files(spark, root, retain_hours=1).isEmpty()

    counts = {r["partition"]: r for r in versions.file_counts(spark, root).collect()}
    assert set(counts) == {"country=Sweden", *(f"country=C{i}" for i in range(5))}
    assert sum(r["listed"] for r in counts.values()) == 72 + log[3]["n_files"]
    assert sum(r["kept"] for r in counts.values()) == log[3]["n_files"]
    assert all(r["kept"] < r["listed"] for r in counts.values())


def test_unfinished_write_is_an_orphan_and_not_read(spark, sales):
    root = fresh_path(spark, "t")
    versions.write_version(sales, root, "WRITE")
    spark.range(3).write.parquet(versions.version_path(root, 1))
    assert versions.live_version(spark, root) == 0
    assert {r["version"] for r in versions.orphan_files(spark, root).collect()} == {1}
    assert versions.write_version(sales, root, "WRITE") == 1
    assert same_rows(sales, versions.read_version(spark, root))


def test_partition_counts(spark):
    df = spark.range(1000)
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        for n in (1, 7, 9, 16, 24, 96, 200):
            skew = layout.partition_skew(df.repartition(n)).first()
            assert (skew["partitions"], skew["rows"]) == (n, 1000)
        base = df.repartition(8)
        for n in (6, 5, 4, 3, 2, 1):
            assert layout.partition_skew(base.coalesce(n)).first()["partitions"] == n
        assert layout.partition_skew(base.coalesce(20)).first()["partitions"] == 8


def test_partition_rule(spark):
    mega = 1024 * 1024
    assert layout.partition_count(0, 8) == 8
    assert layout.partition_count(1600 * mega, 8) == 8
    assert layout.partition_count(1601 * mega, 8) == 9
    path = fresh_path(spark, "t")
    spark.range(1000).write.parquet(path)
    assert layout.stored_bytes(spark, path) == sum(map(os.path.getsize, parquet_files(path)))
    assert layout.partition_count(10**15, 8) == -(-(10**15) // layout.PARTITION_BYTES)
    assert layout.partition_count(10**15, 10**7) == 10**7
    assert layout.compact_files(0, 0) == (1, 0)
    assert layout.compact_files(1000, 90, target_bytes=300) == (4, 23)
    assert layout.compact_files(10**9, 10**6, target_bytes=1000) == (10**6, 1)


def test_wide_ranges_are_cut_into_sorted_files(spark, sales):
    path = fresh_path(spark, "t")
    layout.compact(sales, path, ["id"], ranges=2, rows_per_file=3000)
    back = spark.read.parquet(path)
    assert same_rows(sales, back)
    files = back.groupBy(F.col("_metadata.file_path")).agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")
    )
    ends = files.orderBy("low").collect()
    assert len(ends) >= 7 and max(r["n"] for r in ends) <= 3000
    assert all(a["high"] < b["low"] for a, b in zip(ends, ends[1:]))


def test_empty_table_can_be_a_version(spark, sales):
    root = fresh_path(spark, "t")
    versions.write_version(sales.filter("id < 0"), root, "WRITE")
    assert versions.history(spark, root).first()["n_rows"] == 0
    assert versions.read_version(spark, root).count() == 0
    versions.write_version(sales.filter("id < 0"), root, "WRITE", ["country"])
    assert versions.history(spark, root).count() == 2
    assert versions.orphan_files(spark, root).count() == 1


def test_statistics(spark, sales):
    name = fresh_name("t")
    sales.withColumn("gap", F.when(F.col("id") > 9, F.col("id"))).write.option(
        "path", fresh_path(spark, "t")
    ).saveAsTable(name)
    got = {r["col_name"]: r for r in layout.column_statistics(spark, name).collect()}
    assert (got["code"]["min"], got["code"]["max"]) == ("0", "499")
    assert got["gap"]["num_nulls"] == 10
    assert got["country"]["min"] is None
    assert got["country"]["distinct_count"] == 6


def test_cache_and_discard(spark):
    df = layout.cached(spark.range(10))
    assert df.is_cached
    spark.catalog.clearCache()
    assert not spark.range(10).is_cached
    layout.discard(df)


def test_cluster_session_needs_a_shared_folder():
    class Context:
        master = "spark://elsewhere"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(ValueError):
        shared_folder(Session())
    Session.conf = {"spark.checkpoint.dir": "hdfs://name/scratch/"}
    assert shared_folder(Session()) == "hdfs://name/scratch"


def test_settings_are_put_back(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    with settings(spark, {key: "1MB", "millrace.absent": "1"}):
        assert spark.conf.get(key) == "1MB"
    assert spark.conf.get(key) == before
    assert spark.conf.get("millrace.absent", None) is None
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
