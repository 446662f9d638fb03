"""Compaction, lookups by Bloom filters, and statistics that merge."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import compaction, lookups, sketches


def files_of(path, folder):
    return sorted(glob.glob(os.path.join(path, folder, "*.parquet")))


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_only_crowded_partitions_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "table")
    names = ["many small", "01", "two+large", "empty=ish"]
    made = spark.range(40_000).withColumn("text", F.sha2(F.col("id").cast("string"), 256))

    def put(name, df, count):
        df.withColumn("part", F.lit(name)).repartition(count).write.mode("append").partitionBy("part").parquet(path)

    put(names[0], made, 24)
    put(names[1], made.limit(50), 1)
    put(names[2], made, 2)
    put(names[3], made.limit(10), 3)
    folders = {name: next(f for f in os.listdir(path) if f.startswith("part=" + name[:2])) for name in names}
    before = {name: files_of(path, folder) for name, folder in folders.items()}
    assert [len(before[name]) for name in names] == [24, 1, 2, 3]
    want = rows(spark.read.parquet(path))
    large = min(os.path.getsize(f) for f in before[names[2]])
    target = large - 1  # so that the two large files are left alone
    assert compaction.compact_small_files(spark, path, ["part"], target) == 2
    after = {name: files_of(path, folder) for name, folder in folders.items()}
    assert after[names[1]] == before[names[1]] and after[names[2]] == before[names[2]]
    needed = -(-sum(map(os.path.getsize, after[names[0]])) // target)
    assert len(after[names[0]]) <= needed + 1 < 24 and len(after[names[3]]) == 1
    assert not set(after[names[0]]) & set(before[names[0]])
    assert all(os.path.getsize(f) < 1.5 * target for f in after[names[0]])
    assert rows(spark.read.parquet(path)) == want
    assert compaction.compact_small_files(spark, path, ["part"], target) == 0
    put(names[1], made.limit(20), 2)
    want = rows(spark.read.parquet(path))
    assert compaction.compact_small_files(spark, path, ["part"], target) == 1
    assert len(files_of(path, folders[names[1]])) == 1 and rows(spark.read.parquet(path)) == want


def test_filters_skip_row_groups(spark, small, tmp_path):
    path = str(tmp_path / "filtered")
    medium = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    total = medium.count()
    lookups.write_with_filters(medium, path, ["l_shipdate"], ["l_partkey"], 8, 150, 8_000)
    value = medium.groupBy("l_partkey").count().orderBy("count", "l_partkey").first()["l_partkey"]

    def look(**options):
        found = spark.read.options(**options).parquet(path).where(F.col("l_partkey") == value)
        return rows(found), lookups.rows_scanned(found)

    off = {"parquet.filter.bloom.enabled": "false", "parquet.filter.dictionary.enabled": "false"}
    wanted, read = look()
    assert wanted == rows(medium.where(F.col("l_partkey") == value)) and wanted
    assert read < total / 10
    plain, all_read = look(**off)
    assert plain == wanted and all_read > 5 * read
    none = spark.read.parquet(path).where("l_partkey = -5")
    assert none.collect() == [] and lookups.rows_scanned(none) < total / 10


def test_statistics_of_partitions_merge(spark, tmp_path):
    path = str(tmp_path / "facts")
    df = spark.range(30_000).select(
        (F.col("id") % 3).alias("part"), "id", (F.col("id") * 0.5).alias("half"),
        F.when(F.col("id") % 4 != 0, F.concat(F.lit("t"), (F.col("id") % 700).cast("string"))).alias("text"),
        F.timestamp_seconds("id").alias("at"), F.lit(None).cast("int").alias("nothing"), F.array("id").alias("list"),
    )
    columns = ["id", "half", "text", "at", "nothing"]
    for part in range(3):
        sketches.keep_facts(sketches.partition_facts(df.where(F.col("part") == part), ["part"], columns), path)
    kept = spark.read.parquet(path)
    assert kept.count() == 15
    merged = {r["column"]: r for r in sketches.merged_facts(kept).collect()}
    assert merged["id"]["rows"] == 30_000 and merged["text"]["nulls"] == 7_500
    assert (merged["id"]["least"], merged["id"]["greatest"]) == ("0", "29999")
    assert (merged["half"]["least"], merged["half"]["greatest"]) == ("0.0", "14999.5")
    assert (merged["text"]["least"], merged["text"]["greatest"]) == ("t1", "t99")
    for name, distinct in (("id", 30_000), ("half", 30_000), ("text", 700 * 3 // 4), ("at", 30_000), ("nothing", 0)):
        assert merged[name]["distinct"] == pytest.approx(distinct, rel=sketches.DISTINCT_ERROR)
    for rank, value in zip(sketches.QUANTILES, merged["id"]["quantiles"]):
        assert abs(value / 30_000 - rank) < sketches.RANK_ERROR
    assert merged["text"]["quantiles"] is None and merged["nothing"]["quantiles"] is None
    assert merged["nothing"]["nulls"] == 30_000 and merged["nothing"]["least"] is None
    # The table's facts are those of one pass over it.
    whole = {r["column"]: r for r in sketches.merged_facts(sketches.partition_facts(df, ["part"], columns)).collect()}
    assert {c: whole[c][:6] for c in columns} == {c: merged[c][:6] for c in columns}
    assert sketches.merged_facts(kept.limit(0)).count() == 0
