"""The most frequent items of event-time windows, with state that does not grow with the items.

A count per item keeps a state row for every item ever seen. Here the state of a window is one
frequent-items sketch of at most ``max_items`` counters. When the watermark passes a window, its
sketch gives the window's candidates with estimates, and only then are those that can be among
the first k counted, exactly, in the stored items of that window.

A sketch of n counters misses no item of more than ERROR / n of the window's rows. So if the k-th
candidate is above that, the result is exact as it stands; windows where it is not, as where all
items are rare, are counted in full. Either way the rows are those of counting everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from millrace.streaming.sinks import start_files
from millrace.workspace import materialize

MAX_ITEMS = 10_000
# Twice the sketch's error for one counter: what it does not report has this share at most.
ERROR = 7.0


def missed(max_items: int) -> Column:
    """What an item that the sketch does not report has at most; twice what an estimate is off."""
    return F.col("total") * F.lit(ERROR / max_items)


def candidate_windows(
    items: DataFrame, time: str, item: str, width: str, delay: str, max_items: int = MAX_ITEMS
) -> DataFrame:
    """``start``, ``end``, ``total`` and ``candidates`` of each window, given once, when it is closed.

    A candidate has ``item`` and ``estimate``; they are in falling order of the estimate. Left out
    are those with no more rows than an item may have that the sketch does not report: they decide
    no window, whatever k is.
    """
    sketched = (
        items.where(F.col(item).isNotNull())
        .withWatermark(time, delay)
        .groupBy(F.window(time, width).alias("window"))
        .agg(
            F.count("*").alias("total"),
            F.expr(f"approx_top_k(`{item}`, {max_items}, {max_items})").alias("top"),
        )
    )
    candidate = "array<struct<item: {}, estimate: bigint>>".format(items.schema[item].dataType.simpleString())
    candidates = F.filter(F.col("top").cast(candidate), lambda x: x["estimate"] > missed(max_items) / 2)
    return sketched.select("window.start", "window.end", "total", candidates.alias("candidates"))


def start_topk(
    items: DataFrame,
    time: str,
    item: str,
    width: str,
    delay: str,
    folder: str,
    max_items: int = MAX_ITEMS,
    every: str | None = None,
) -> list[StreamingQuery]:
    """Store the items of a stream, and the candidates of closed windows, below ``folder``."""
    kept = items.where(F.col(item).isNotNull()).select(time, item)
    windows = candidate_windows(items, time, item, width, delay, max_items)
    return [
        start_files(kept, f"{folder}/items", f"{folder}/items-checkpoint", every=every),
        start_files(windows, f"{folder}/windows", f"{folder}/windows-checkpoint", every=every),
    ]


def first_of_window(counted: DataFrame, item: str, k: int) -> DataFrame:
    """The ``k`` most frequent items of each window; equal counts are ordered by item."""
    # Spark cuts each task's rows to their own first k before the shuffle.
    order = W.partitionBy("start").orderBy(F.desc("count"), item)
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def likely_items(windows: DataFrame, item: str, k: int, max_items: int = MAX_ITEMS) -> DataFrame:
    """``start`` and the item of all candidates that can be among the first ``k`` of their window."""
    # The k-th and the candidate itself are each off by half of this at most.
    least = F.get("candidates", F.lit(k - 1))["estimate"] - missed(max_items)
    likely = F.filter("candidates", lambda x: x["estimate"] >= F.coalesce(least, F.lit(0.0)))
    return windows.select("start", F.explode(likely["item"]).alias(item))


def exact_topk(
    items: DataFrame, windows: DataFrame, time: str, item: str, width: str, k: int, max_items: int = MAX_ITEMS
) -> DataFrame:
    """``start``, ``end``, ``rank``, the item and its ``count`` for each closed window."""
    placed = items.where(F.col(item).isNotNull()).select(F.window(time, width)["start"].alias("start"), item)

    def counts(chosen: DataFrame, keys: list[str]) -> DataFrame:
        return placed.join(chosen, keys, "left_semi").groupBy("start", item).agg(F.count("*").alias("count"))

    # A few rows a window: once stored, their size is known before the items are read and need not be shuffled.
    likely = materialize(likely_items(windows, item, k, max_items), "likely-items")
    found = materialize(first_of_window(counts(likely, ["start", item]), item, k), "likely-topk")
    sure = (
        found.groupBy("start").agg(F.min("count").alias("least"), F.count("*").alias("n"))
        .join(windows, "start").where((F.col("n") == k) & (F.col("least") > missed(max_items))).select("start")
    )
    unsure = materialize(windows.select("start").join(sure, "start", "left_anti"), "unsure-windows")
    rest = first_of_window(counts(unsure, ["start"]), item, k)
    both = found.join(unsure, "start", "left_anti").unionByName(rest)
    return both.join(windows.select("start", "end"), "start").select("start", "end", "rank", item, "count")


def read_topk(spark, folder: str, time: str, item: str, width: str, k: int, max_items: int = MAX_ITEMS) -> DataFrame:
    """The result of what :func:`start_topk` has stored so far."""
    items, windows = (spark.read.parquet(f"{folder}/{part}") for part in ("items", "windows"))
    return exact_topk(items, windows, time, item, width, k, max_items)
