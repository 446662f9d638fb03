"""Counts over event-time windows, for tables and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.workspace import materialize

# Slots of a session gap that one task joins for a key.
CHUNK_SLOTS = 1_000


def window_count(
    df: DataFrame,
    ts: str,
    width: str,
    slide: str | None = None,
    keys: Sequence[str | Column] = (),
) -> DataFrame:
    """Rows per window and key: ``start``, ``end``, the keys, ``count``.

    Windows tumble, or slide when ``slide`` is given; the start belongs to the
    window, the end does not.
    """
    span = F.window(ts, width, slide) if slide else F.window(ts, width)
    counted = df.groupBy(span.alias("window"), *keys).agg(F.count("*").alias("count"))
    names = [name for name in counted.columns if name not in ("window", "count")]
    return counted.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), *names, "count"
    )


def session_count(df: DataFrame, ts: str, gap: str, keys: Sequence[str]) -> DataFrame:
    """Rows per session and key: the keys, ``start``, ``end``, ``count``.

    A session ends when the key stays silent for longer than ``gap``, and its
    end lies one gap after its last row. A table is counted in two steps, see
    :func:`sessions_of_slots`.
    """
    if not df.isStreaming:
        return sessions_of_slots(df, ts, gap, keys)
    session = F.session_window(ts, gap).alias("session")
    return session_columns(df.groupBy(*keys, session).agg(F.count("*").alias("count")), keys)


def session_columns(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    return counted.select(
        *keys,
        F.col("session.start").alias("start"),
        F.col("session.end").alias("end"),
        "count",
    )


def seconds(interval: Column) -> Column:
    """A day-time interval as seconds."""
    return interval.cast("interval second").cast("decimal(18,6)")


def sessions_of_slots(
    df: DataFrame, ts: str, gap: str, keys: Sequence[str], chunk_slots: int = CHUNK_SLOTS
) -> DataFrame:
    """Sessions joined from slots of one gap's width, first inside chunks of time.

    Rows of a key in one slot are never more than a gap apart, so they share a
    session and shrink to first time, last time and count before the shuffle.
    Each slot then counts as a session of its own length, and those that touch
    become one: within chunks of ``chunk_slots`` slots, so that a busy key is
    many tasks' work, and then, of a key, only those that reach a border of
    their chunk.
    """
    slots = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*keys, F.window(ts, gap).alias("slot"))
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count("*").alias("_rows"))
    )
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    micros = lambda interval: (seconds(interval) * 1_000_000).cast("bigint")
    gap_micros = micros(start + F.expr(f"INTERVAL '{gap}'") - start)
    chunk_micros = gap_micros * chunk_slots

    def at(time: str) -> Column:
        return micros(F.col(time).cast("timestamp_ntz") - start)

    length = F.col("_last") - F.col("_first") + F.expr(f"INTERVAL '{gap}'")
    placed = slots.withColumn("_chunk", (at("_first") - F.pmod(at("_first"), chunk_micros)))
    # Stored, since it is read twice, for the pieces that stay and for those that may join.
    pieces = materialize(session_columns(
        placed.groupBy(
            *keys, "_chunk",
            F.session_window("_first", F.make_interval(secs=seconds(length))).alias("session"),
        ).agg(F.sum("_rows").alias("count")),
        [*keys, "_chunk"],
    ), "session-pieces")
    reaches = (at("start") <= F.col("_chunk") + gap_micros) | (
        at("end") >= F.col("_chunk") + chunk_micros
    )
    joined = pieces.filter(reaches).groupBy(
        *keys,
        F.session_window(
            "start", F.make_interval(secs=seconds(F.col("end") - F.col("start")))
        ).alias("session"),
    ).agg(F.sum("count").alias("count"))
    return pieces.filter(~reaches).drop("_chunk").union(session_columns(joined, keys))
