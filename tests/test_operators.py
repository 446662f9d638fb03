"""Groups, positions and summaries against brute force, with hot keys and ties."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.operators import groups, positions, summaries
from millrace.workspace import settings


def skewed(spark, n=1000):
    """A third of all rows under key 0, some under null."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(
        F.col("id") % 97 + 1
    )
    return spark.range(n).select(key.alias("k"), (F.col("id") % 40).alias("v"), "id")


def by_key(rows, key, value):
    found = defaultdict(list)
    for row in rows:
        found[row[key]].append(row[value])
    return found


def in_order(rows, key=None):
    """Arrays of each group by chunk."""
    found = defaultdict(dict)
    for row in rows:
        assert row["chunk"] not in found[row[key] if key else 0]
        found[row[key] if key else 0][row["chunk"]] = row["values"]
    return {k: [chunks[i] for i in range(len(chunks))] for k, chunks in found.items()}


def cut(values, items):
    return [values[i : i + items] for i in range(0, len(values), items)]


@pytest.mark.parametrize("ranges", [None, 1, 5])
@pytest.mark.parametrize("items", [1, 3, 20, 10_000])
def test_collected_arrays_are_stretches_of_the_sorted_values(spark, items, ranges):
    df = skewed(spark).repartition(7)
    want = {k: cut(sorted(v), items) for k, v in by_key(df.collect(), "k", "v").items()}
    assert in_order(groups.collect_values(df, ["k"], "v", items, ranges).collect(), "k") == want
    distinct = {k: cut(sorted(set(v)), items) for k, v in by_key(df.collect(), "k", "v").items()}
    assert in_order(groups.collect_distinct(df, ["k"], "v", items, ranges).collect(), "k") == distinct


def test_equal_rows_of_one_group_fill_several_arrays(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    assert in_order(groups.collect_values(df, ["k"], "v", 100).collect(), "k") == {1: [["x"] * 100] * 50}
    assert in_order(groups.collect_distinct(df, ["k"], "v", 100).collect(), "k") == {1: [["x"]]}


def test_collect_whole_table(spark):
    df = spark.range(100)
    assert in_order(groups.collect_values(df, [], "id", 1000).collect()) == {0: [list(range(100))]}
    assert in_order(groups.collect_values(df, [], "id", 10).collect()) == {0: cut(list(range(100)), 10)}
    assert groups.collect_values(df.limit(0), [], "id", 10).count() == 0


@pytest.mark.parametrize("parts", [1, 7, 16])
def test_row_index_is_consecutive(spark, parts):
    df = spark.range(1000).select((1000 - F.col("id")).alias("x")).repartition(parts)
    got = positions.with_row_index(df, ["x"]).orderBy("row_idx").collect()
    assert [(r["row_idx"], r["x"]) for r in got] == [(i, i) for i in range(1, 1001)]
    arrival = positions.with_row_index(df, name="n", start=0)
    assert sorted(r["n"] for r in arrival.collect()) == list(range(1000))


def test_row_index_is_stable_with_ties(spark):
    df = spark.range(500).select("id", F.lit(1).alias("same")).repartition(5)
    numbered = positions.with_row_index(df, ["same"])
    first = {r["id"]: r["row_idx"] for r in numbered.collect()}
    assert first == {r["id"]: r["row_idx"] for r in numbered.repartition(3).collect()}
    assert sorted(first.values()) == list(range(1, 501))


def test_rows_that_tie_fall_into_several_ranges(spark):
    """One value everywhere must not put the whole table into one partition."""
    df = spark.range(8000).select("id", F.lit(1).alias("same"))
    # Otherwise Spark merges partitions as small as these.
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        placed, _ = positions.place_rows(df, ["same"])
    sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    assert sum(sizes) == 8000 and len(sizes) == 8 and max(sizes) < 2000


def test_rows_with_maps_can_be_numbered(spark):
    df = spark.range(20).select("id", F.create_map(F.lit("a"), "id").alias("m"))
    got = positions.with_row_index(df, ["id"]).orderBy("row_idx").collect()
    assert [(r["row_idx"], r["m"]["a"]) for r in got] == [(i + 1, i) for i in range(20)]


def test_positional_join_cuts_the_longer_side_first(spark):
    left = spark.range(1000).select(F.col("id").alias("a")).repartition(3)
    right = spark.range(100).select(F.col("id").alias("b")).repartition(4)
    joined = positions.positional_join(left, right, ["a"], ["b"])
    assert sorted(map(tuple, joined.collect())) == [(i, i) for i in range(100)]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    top = plan.index("Join Inner")
    assert plan.count("< 100)", top) >= 2  # both sides are filtered below the join


def test_positional_join_stops_at_the_shorter_side(spark):
    left = spark.range(10).select(F.col("id").alias("a")).repartition(3)
    right = spark.range(100, 107).select(F.col("id").alias("b")).repartition(4)
    got = positions.positional_join(left, right, ["a"], [F.desc("b")])
    assert sorted(map(tuple, got.collect())) == [(i, 106 - i) for i in range(7)]


@pytest.mark.parametrize("ranges", [None, 4])
@pytest.mark.parametrize("n", [0, 1, 5, 999, 1500, 5000])
def test_sort_limit_both_ways(spark, n, ranges):
    df = spark.range(2000).select((F.col("id") * 7 % 2000).alias("x")).repartition(9)
    want = list(range(min(n, 2000)))
    for short in (-1, 10_000):
        got = positions.sort_limit(df, ["x"], n, ranges=ranges, short=short)
        assert [r["x"] for r in got.collect()] == want


@pytest.mark.parametrize("ascending", [True, False, [False, True]])
@pytest.mark.parametrize("n", [3, 100, 250, 700])
def test_sort_limit_with_hot_values_and_nulls(spark, n, ascending):
    """A third of all rows ties in the first column, some have none."""
    df = skewed(spark, 1500).select("k", "id")
    ups = [ascending] * 2 if isinstance(ascending, bool) else ascending
    order = [F.asc(c) if up else F.desc(c) for c, up in zip(["k", "id"], ups)]
    want = [tuple(r) for r in df.orderBy(*order).limit(n).collect()]
    got = positions.sort_limit(df.repartition(5), ["k", "id"], n, ascending, short=-1)
    assert [tuple(r) for r in got.collect()] == want


def test_limits_are_nested_also_where_rows_tie(spark):
    """A longer limit holds the rows of a shorter one, whichever way either is found."""
    df = spark.range(6000).select((F.col("id") % 3).alias("same"), "id").repartition(5)
    kept = [
        {tuple(r) for r in positions.sort_limit(df, ["same"], n, short=1000).collect()}
        for n in (999, 1000, 1001, 1500)
    ]
    assert [len(rows) for rows in kept] == [999, 1000, 1001, 1500]
    assert all(a < b for a, b in zip(kept, kept[1:]))


def test_longest_text(spark):
    df = spark.createDataFrame(
        [("aa", "b", 7), ("zz", None, 5), ("é", "żó", None)], "x string, y string, z int"
    )
    best = summaries.longest_text(df).collect()
    assert [tuple(r) for r in best] == [("None", 4)]
    assert tuple(summaries.longest_text(df, ["x"]).first()) == ("zz", 2)
    assert tuple(summaries.longest_text(df, ["x", "y"], null_text="").first()) == ("żó", 2)


def test_describe_columns_matches_describe(spark):
    numbers = spark.range(50).select((F.col("id") * 1.5).alias("a"), F.col("id").alias("b"), F.lit(True))
    texts = spark.createDataFrame([("7", "x"), ("11", None), (None, "ab")], "n string, t string")
    for df, names in ((numbers, ["a", "b"]), (texts, ["n", "t"])):
        got = {r["column"]: r for r in summaries.describe_columns(df).collect()}
        assert set(got) == set(names)
        want = {r["summary"]: r for r in df.select(*names).describe().collect()}
        for name in names:
            for fact in ("count", "mean", "stddev", "min", "max"):
                assert got[name][fact] == want[fact][name], (name, fact)


def test_describe_columns_keeps_whole_numbers_exact(spark):
    df = spark.createDataFrame([(2**53 + 1,), (3,)], "n bigint")
    row = summaries.describe_columns(df).first()
    assert (row["min"], row["max"]) == ("3", "9007199254740993")
    assert summaries.describe_columns(df.select(F.lit(True))).count() == 0


def test_top_counts_break_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    got = summaries.top_counts(df, ["k"], 2).collect()
    assert [tuple(r) for r in got] == [("c", 2), ("a", 1)]


def test_a_long_limit_cuts_each_task_before_the_shuffle(spark):
    df = spark.range(0, 40_000, 1, 6).select((F.col("id") * 7 % 40_000).alias("x"))
    n = 1_500
    with settings(spark, {positions.GROUP_LIMIT: str(n + 1)}):
        cut = positions.first_of_each_task(df, [F.asc("x")], n)
        plan = cut._jdf.queryExecution().executedPlan().toString()
        assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning(_task")
        assert cut.count() == 6 * n
    got = positions.sort_limit(df, ["x"], n)
    assert [r["x"] for r in got.collect()] == list(range(n))


def test_one_carry_row_for_each_range(spark):
    """However many groups there are, and also where one group fills most ranges."""
    rows = [(1, i) for i in range(3_000)] + [(None, i) for i in range(500)] + [(2 + i % 700, 5_000 + i) for i in range(1_400)]
    counted = spark.createDataFrame(rows, "k long, v long").withColumn("_n", F.lit(1).cast("bigint"))
    placed = positions.in_ranges(counted, ["k", "v"], 9).withColumn("_part", F.spark_partition_id())
    assert groups.carries(placed, ["k"]).count() <= 9
    found = groups.with_start(counted, ["k"], "v", 9).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r))
    start = {}
    for k, v in order:
        start[k, v] = start.get(k, 0)
        start[k] = start.get(k, 0) + 1
    assert {(r["k"], r["v"]): r["_start"] for r in found} == {row: start[row] for row in rows}
    whole = groups.with_start(counted.select("v", "_n").groupBy("v").agg(F.sum("_n").alias("_n")), [], "v", 4)
    assert whole.agg(F.max("_start")).first()[0] == len(rows) - 1
