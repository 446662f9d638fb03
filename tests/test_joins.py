"""Joins with heavy keys: equal to the plain join, and spread; joins of bucketed tables: no exchange."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import joins
from millrace.workspace import fresh_name, fresh_path, settings

PLAIN = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def tables(spark):
    rng = random.Random(6)
    keys = [1] * 600 + [None] * 300 + [rng.randrange(2, 60) for _ in range(300)]
    left = [(key, rng.randrange(3) if key == 1 else 0, i) for i, key in enumerate(keys)]
    right = [(key, sub, f"r{key}-{sub}-{n}") for key in (*range(1, 40), None) for sub in (0, 1) for n in range(key == 1 and 3 or 1)]
    return (
        spark.createDataFrame(left, "key long, sub long, id long"),
        spark.createDataFrame(right, "key long, sub long, name string"),
    )


@pytest.mark.parametrize("how", joins.SALTED_JOINS)
@pytest.mark.parametrize("keys", [["key"], ["key", "sub"]])
def test_equal_to_the_plain_join(spark, how, keys):
    left, right = tables(spark)
    right = right if len(keys) == 2 else right.drop("sub")
    with settings(spark, PLAIN):
        got, want = joins.join_with_heavy_keys(left, right, keys, how), left.join(right, keys, how)
        assert got.columns == want.columns
        assert rows(got) == rows(want)


def test_other_joins_are_refused(spark):
    left, right = tables(spark)
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            joins.join_with_heavy_keys(left, right, ["key"], how)


def largest_share(df):
    counted = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(counted) / sum(counted)


def test_heavy_keys_are_spread(spark):
    left = spark.range(80_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 900).alias("key"), "id"
    )
    right = spark.range(900).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    with settings(spark, {**PLAIN, "spark.sql.shuffle.partitions": "32"}):
        plain = left.join(right, "key", "left")
        dealt = joins.join_with_heavy_keys(left, right, ["key"], "left")
        assert largest_share(plain) > 0.5
        assert largest_share(dealt) < 0.12
        assert dealt.count() == plain.count() == 80_000
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        heavy = {r["key"]: r["_salts"] for r in joins.heavy_keys(left, ["key"]).collect()}
        assert heavy == {7: 17, None: 4}
        repeated = joins.repeated(right, joins.heavy_keys(left, ["key"]), ["key"])
        assert repeated.count() == 900 + 16  # only the heavy key's row is repeated


def test_no_rows_and_few_rows(spark):
    left, right = tables(spark)
    assert joins.join_with_heavy_keys(left.limit(0), right.drop("sub"), ["key"]).count() == 0
    assert joins.join_with_heavy_keys(left, right.drop("sub").limit(0), ["key"], "left").count() == 1200
    assert joins.heavy_keys(left.limit(0), ["key"]).count() == 0


@pytest.mark.parametrize("salts", [1, 3])
@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_bucketed_tables_join_without_an_exchange(spark, salts, how):
    left, right = tables(spark)
    left, right = left.drop("sub"), right.select(F.col("key").alias("other"), "name")
    names, paths = [fresh_name("a"), fresh_name("b")], [fresh_path(spark, "a"), fresh_path(spark, "b")]
    joins.write_for_join(left, names[0], paths[0], right, names[1], paths[1], "key", "other", 4, salts)
    joined = joins.join_buckets(spark, *names, "key", "other", how)
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert rows(joined) == rows(left.join(right, left["key"] == right["other"], how))
