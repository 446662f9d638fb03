"""Streams: equal to the batch result, resumable, exactly once; and what Spark refuses."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.functions.jsontext import as_message
from millrace.plans.renderings import edit_messages, envelopes, log_lines, tweet_messages
from millrace.sources import messages
from millrace.sources.ingest import json_file_stream, remembered_schema
from millrace.streaming import jobs, progress, sinks, topk, windows
from millrace.workspace import fresh_name, settings


def put_files(folder, texts, start=0):
    """One file per text, with rising modification times."""
    os.makedirs(folder, exist_ok=True)
    for number, text in enumerate(texts, start=start):
        path = os.path.join(folder, f"part-{number:03}.txt")
        with open(path, "w") as out:
            out.write(text + "\n")
        stamp = time.time() - 1000 + number
        os.utime(path, (stamp, stamp))


def line(clock, level="ERROR", text="it broke"):
    return f"[2024/01/01 {clock}] ({level}) {text}"


def rows(df):
    return sorted(map(tuple, df.collect()))


def clock(row):
    return (row["start"].strftime("%H:%M:%S"), row["count"])


WATERMARK_CASE = [
    line("00:00:00.000"), line("00:10:00.000"), line("00:20:00.000"),
    line("00:00:00.000"), line("00:30:00.000"),
]


def test_log_parsing(spark):
    lines = spark.createDataFrame(
        [(line("10:11:12.345"),), (line("10:11:13.000", "INFO"),), ("no log line (ERROR) x",)],
        "value string",
    )
    got = jobs.log_records(lines).collect()
    assert got[0]["capturedAt"] == dt.datetime(2024, 1, 1, 10, 11, 12)
    assert got[0]["logData"] == "(ERROR) it broke"
    assert got[2]["capturedAt"] is None and got[2]["logData"] == ""
    assert jobs.log_errors(lines).count() == 2


def test_late_row_is_dropped_in_append_mode(spark, tmp_path):
    put_files(tmp_path / "in", WATERMARK_CASE)
    stream = messages.line_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    got = sinks.run_to_table(jobs.errors_per_second(stream)).orderBy("start").collect()
    assert [clock(r) for r in got] == [("00:00:00", 1), ("00:10:00", 1), ("00:20:00", 1)]


def test_complete_mode_keeps_late_rows(spark, tmp_path):
    put_files(tmp_path / "in", WATERMARK_CASE)
    stream = messages.line_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    counted = jobs.errors_per_second(stream).orderBy("start")
    got = [clock(r) for r in sinks.run_to_memory(counted).collect()]
    assert got == [("00:00:00", 2), ("00:10:00", 1), ("00:20:00", 1), ("00:30:00", 1)]


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    table, path = fresh_name("counts"), str(tmp_path / "out")

    def run():
        stream = messages.line_stream(spark, folder, max_files_per_trigger=1)
        query = sinks.start_table(jobs.errors_per_second(stream), table, checkpoint, path)
        query.awaitTermination()
        return [clock(r) for r in spark.table(table).orderBy("start").collect()]

    put_files(folder, [line("00:00:00.100"), line("00:00:00.200")])
    assert run() == []
    put_files(folder, [line("00:00:00.300"), line("00:10:00.000")], start=2)
    assert run() == [("00:00:00", 3)]
    assert run() == [("00:00:00", 3)]


def test_streams_equal_batches(spark, small, tmp_path):
    """Many small batches give what one pass over the table gives."""
    events = spark.read.parquet(f"{small}/events.parquet")
    folder = str(tmp_path / "in")
    events.withColumn("ts", F.col("ts").cast("timestamp")).repartition(6).write.parquet(folder)
    schema = spark.read.parquet(folder).schema

    def stream():
        return messages.file_stream(spark, folder, schema, max_files_per_trigger=1)

    batch = spark.read.parquet(folder)
    for count in (
        lambda df: windows.window_count(df, "ts", "1 hour", keys=["event_type"]),
        lambda df: windows.window_count(df, "ts", "1 hour", "30 minutes"),
        jobs.running_count,
        lambda df: windows.session_count(df, "ts", "6 hours", ["user_id"]),
    ):
        assert rows(sinks.run_to_memory(count(stream()))) == rows(count(batch))


@pytest.mark.parametrize(
    ("render", "source", "job"),
    [
        (log_lines, "events", lambda df: jobs.errors_per_second(df)),
        (edit_messages, "events", lambda df: jobs.anonymous_edits_per_country(df)),
        (tweet_messages, "documents", lambda df: jobs.popular_hashtags(df)),
    ],
)
def test_jobs_equal_batches(spark, small, tmp_path, render, source, job):
    texts = render(spark.read.parquet(f"{small}/{source}.parquet"))
    folder = str(tmp_path / "in")
    texts.repartition(3).write.text(folder)
    stream = messages.line_stream(spark, folder, max_files_per_trigger=1)
    assert rows(sinks.run_to_memory(job(stream))) == rows(job(texts))


@pytest.mark.parametrize("gap", ["1 minute", "37 minutes", "6 hours", "3 days"])
def test_sessions_of_a_table_equal_spark_sessions(spark, small, gap):
    """Also for a user with most of the rows, and rows exactly one gap apart."""
    events = spark.read.parquet(f"{small}/events.parquet").select("user_id", "ts")
    busy = events.select(F.lit(-1).cast("bigint").alias("user_id"), "ts")
    start = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    even = spark.range(5).select(
        F.lit(-2).cast("bigint").alias("user_id"),
        (start + F.expr(f"INTERVAL '{gap}'") * F.col("id")).alias("ts"),
    )
    missing = spark.createDataFrame([(-3, None)], "user_id bigint, ts timestamp_ntz")
    df = events.unionAll(busy).unionAll(even).unionAll(missing).repartition(5)
    plain = df.groupBy("user_id", F.session_window("ts", gap).alias("w")).count()
    want = rows(plain.select("user_id", "w.start", "w.end", "count"))
    got = windows.session_count(df, "ts", gap, ["user_id"])
    assert rows(got) == want
    assert got.filter("user_id = -2").count() == 1
    for slots in (1, 3, 50):
        assert rows(windows.sessions_of_slots(df, "ts", gap, ["user_id"], slots)) == want


def test_window_bounds(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 12, 5),), (dt.datetime(2024, 1, 1, 12, 4, 59, 999999),)],
        "ts timestamp_ntz",
    )
    got = windows.window_count(df, "ts", "5 minutes").orderBy("start").collect()
    bounds = [(r["start"].minute, r["end"].minute, r["count"]) for r in got]
    assert bounds == [(0, 5, 1), (5, 10, 1)]


def test_files_are_ingested_once(spark, small, tmp_path):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    store, table = str(tmp_path / "schema"), fresh_name("events")
    events = spark.read.parquet(f"{small}/events.parquet").select("event_id", "event_type")

    def run():
        stream = json_file_stream(spark, folder, store)
        sinks.start_table(stream, table, checkpoint, str(tmp_path / "out")).awaitTermination()
        return spark.table(table)

    events.filter("event_id % 2 = 0").repartition(3).write.json(folder)
    first = events.filter("event_id % 2 = 0").count()
    assert run().count() == first
    assert run().count() == first
    events.filter("event_id % 2 = 1").write.mode("append").json(folder)
    done = run()
    assert rows(done.select("event_id", "event_type")) == rows(events)
    assert done.select("source_file").distinct().count() >= 4
    assert done.filter("processing_time is null").isEmpty()


def test_schema_is_remembered(spark, tmp_path):
    folder, store = str(tmp_path / "in"), str(tmp_path / "schema")
    spark.range(3).write.json(folder)
    first = remembered_schema(spark, folder, store)
    spark.range(3).withColumn("more", F.lit("x")).write.mode("append").json(folder)
    assert remembered_schema(spark, folder, store) == first
    assert first.simpleString() == "struct<id:bigint>"
    texts = remembered_schema(spark, folder, str(tmp_path / "texts"), infer_types=False)
    assert texts.simpleString() == "struct<id:string,more:string>"


def test_message_replay_and_topics(spark, small, tmp_path):
    folder = str(tmp_path / "in")
    stored = envelopes(spark.read.parquet(f"{small}/events.parquet"))
    stored.repartition(4).write.parquet(folder)

    def replay(**topics):
        stream = messages.replay_messages(spark, folder, max_files_per_trigger=1, **topics)
        return sinks.run_to_table(messages.with_text_value(stream)).count()

    chosen = stored.filter("topic in ('click', 'view')")
    assert replay(subscribe=["click", "view"]) == chosen.count()
    assert replay(subscribe_pattern="err") == 0
    assert replay(subscribe_pattern="err.*") == stored.filter("topic = 'error'").count()
    assert (
        replay(assign={"click": [0], "view": [1, 2]})
        == stored.filter(
            "(topic = 'click' and partition = 0) or (topic = 'view' and partition in (1, 2))"
        ).count()
    )


def test_kafka_options():
    assert messages.kafka_options("h:9092", subscribe="a, b", max_offsets_per_trigger=10) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "a,b", "maxOffsetsPerTrigger": "10",
    }
    options = messages.kafka_options("h", assign={"a": [1, 3]}, starting_offsets="earliest")
    assert options["assign"] == '{"a": [1, 3]}' and options["startingOffsets"] == "earliest"
    assert messages.kafka_options("h", subscribe_pattern="t.*")["subscribePattern"] == "t.*"
    with pytest.raises(ValueError):
        messages.kafka_options("h")
    with pytest.raises(ValueError):
        messages.in_topics(subscribe="a", subscribe_pattern="b")


def test_timed_query_can_be_watched_and_stopped(spark, tmp_path):
    put_files(tmp_path / "in", WATERMARK_CASE)
    stream = messages.line_stream(spark, str(tmp_path / "in"))
    name = fresh_name("watched")
    query = sinks.start_memory(
        jobs.running_count(stream), name, str(tmp_path / "checkpoint"), every="1 second"
    )
    query.processAllAvailable()
    facts = sinks.query_facts(query)
    assert facts["name"] == name and facts["active"]
    assert facts["last_progress"] is not None and "Physical Plan" in facts["plan"]
    assert spark.sql(f"SELECT * FROM {name}").first()["count"] == 5
    sinks.stop_all(spark)
    assert not query.isActive and not spark.streams.active


def test_state_width_and_settings(spark):
    assert sinks.state_partitions(spark) == 8
    with settings(spark, {sinks.WIDTH: "200"}):
        assert sinks.state_partitions(spark) == 200
    assert sinks.stream_settings(spark, 3)[sinks.WIDTH] == "3"


def test_sorting_a_stream_is_refused(spark, tmp_path):
    put_files(tmp_path / "in", WATERMARK_CASE)
    errors = jobs.log_errors(messages.line_stream(spark, str(tmp_path / "in")))
    with pytest.raises(AnalysisException):
        sinks.start_memory(
            errors.orderBy("capturedAt"), fresh_name("q"), str(tmp_path / "c1"), mode="append"
        )


def test_topk_in_append_mode_is_refused(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    stream = messages.line_stream(spark, str(tmp_path / "in"))
    with pytest.raises(AnalysisException):
        sinks.start_memory(
            jobs.popular_hashtags(stream), fresh_name("q"), str(tmp_path / "c2"), mode="append"
        )


def test_tweets_and_edits(spark):
    tweet = spark.createDataFrame(
        [('{"hashTags":["A","a",null],"createdAt":1582971072345,"place":{"name":"X"}}',), ("bad",)],
        "value string",
    )
    got = jobs.tweets(tweet).orderBy(F.col("createdAt").isNull()).collect()
    assert got[0]["time"].microsecond == 345000 and got[0]["place"]["name"] == "X"
    assert got[1]["time"] is None
    assert rows(jobs.popular_hashtags(tweet).na.fill("-")) == [("-", 1), ("a", 2)]

    row = {
        "namespace": "article", "isAnonymous": True, "geocoding": {"countryCode3": "POL"},
        "timestamp": "2024-01-01T00:00:01.900Z",
    }
    edits = [
        row,
        {**row, "namespace": "talk"},
        {**row, "isAnonymous": False},
        {**row, "geocoding": {"countryCode3": None}},
        {**row, "geocoding": None},
    ]
    texts = spark.createDataFrame([(json.dumps(e),) for e in edits] + [("bad",)], "value string")
    assert jobs.edits(texts).count() == 6
    got = jobs.anonymous_edits_per_country(texts).orderBy("start").collect()
    assert [(r["start"].time(), r["countryCode3"], r["count"]) for r in got] == [
        (dt.time(0, 0, 0, 500000), "POL", 1), (dt.time(0, 0, 1), "POL", 1)
    ]
    assert as_message(spark.range(1)).first()["value"] == '{"id":0}'


def tag_rows(spark, folder, batches):
    """One file per batch of (seconds, tag) rows, as a stream."""
    schema = "at timestamp, tag string"
    for number, batch in enumerate(batches):
        df = spark.createDataFrame([(dt.datetime.fromtimestamp(s, dt.timezone.utc), tag) for s, tag in batch], schema)
        df.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.02)
    return messages.file_stream(spark, folder, schema, max_files_per_trigger=1)


def slow_topk(batches, width, closed, k):
    counts = {}
    for at, tag in (row for batch in batches for row in batch):
        start = at // width * width
        if tag is not None and start + width <= closed:
            counts[start, tag] = counts.get((start, tag), 0) + 1
    found = []
    for start in sorted({start for start, _ in counts}):
        ordered = sorted((-n, tag) for (s, tag), n in counts.items() if s == start)[:k]
        found += [(start, rank, tag, -n) for rank, (n, tag) in enumerate(ordered, 1)]
    return found


@pytest.mark.parametrize("max_items", [8, 1_000])
def test_topk_of_windows_is_exact(spark, tmp_path, max_items):
    """With few counters frequent tags decide some windows and others are counted in full."""
    batches = [
        [(60 * b + s % 60, f"often{s % 3}") for s in range(400)]
        + [(60 * b + s % 60, f"new{b}-{s}") for s in range(150)] + [(60 * b, None)]
        for b in range(3)
    ] + [[(200 + s, f"single{s}") for s in range(30)], [(1_000, "end")]]
    stream = tag_rows(spark, str(tmp_path / "in"), batches)
    for query in topk.start_topk(stream, "at", "tag", "1 minute", "10 seconds", str(tmp_path), max_items):
        query.awaitTermination()
    got = topk.read_topk(spark, str(tmp_path), "at", "tag", "1 minute", 4, max_items)
    found = [(int(r["start"].timestamp()), r["rank"], r["tag"], r["count"]) for r in got.orderBy("start", "rank").collect()]
    assert found == slow_topk(batches, 60, 990, 4)


@pytest.mark.parametrize("max_items", [64, 1_000])
def test_topk_counts_only_what_can_be_first(spark, tmp_path, max_items):
    """Of hundreds of tags a window those near the k-th are kept and counted, ties included, also if estimates are off."""
    often = {"a": 400, "b": 330, "d": 300, "c": 300, "e": 20}
    batches = [
        [(60 * b + s % 60, tag) for tag, n in often.items() for s in range(n)]
        + [(60 * b + s % 60, f"single{b}-{s}") for s in range(500)]
        for b in range(2)
    ] + [[(1_000, "end")]]
    stream = tag_rows(spark, str(tmp_path / "in"), batches)
    for query in topk.start_topk(stream, "at", "tag", "1 minute", "10 seconds", str(tmp_path), max_items):
        query.awaitTermination()
    stored = spark.read.parquet(f"{tmp_path}/windows")
    assert [r[0] for r in stored.select(F.max(F.size("candidates"))).collect()][0] <= len(often)
    likely = topk.likely_items(stored, "tag", 3, max_items)
    starts = {r["start"] for r in stored.collect()}
    assert sorted(map(tuple, likely.collect())) == sorted((start, tag) for start in starts for tag in "abcd")
    got = topk.read_topk(spark, str(tmp_path), "at", "tag", "1 minute", 3, max_items).orderBy("start", "rank")
    found = [(int(r["start"].timestamp()), r["rank"], r["tag"], r["count"]) for r in got.collect()]
    assert len(starts) == 2 and found == slow_topk(batches, 60, 990, 3)


def test_state_of_topk_is_bounded(spark, tmp_path):
    """Ever new tags: the plain count keeps a row for each, the sketch one for each open window."""
    batches = [[(60 * b + s % 60, f"tag{b}-{s}") for s in range(300)] for b in range(5)]
    stream = tag_rows(spark, str(tmp_path / "in"), batches)
    _, query = topk.start_topk(stream, "at", "tag", "1 minute", "10 seconds", str(tmp_path), 100)
    query.awaitTermination()
    kept = [row[8] for row in progress.progress_rows(query)]
    assert max(kept) <= 3
    counts = sinks.start_memory(
        stream.groupBy("tag").count(), fresh_name("tags"), str(tmp_path / "plain"), mode="complete"
    )
    counts.awaitTermination()
    assert max(row[8] for row in progress.progress_rows(counts)) == 1_500


def test_progress_is_kept_once(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "progress")
    assert progress.kept_progress(spark, path).count() == 0
    put_files(folder, WATERMARK_CASE)

    def run(name):
        stream = messages.line_stream(spark, folder, max_files_per_trigger=1)
        query = sinks.start_files(
            jobs.errors_per_second(stream), str(tmp_path / "out"), str(tmp_path / "checkpoint")
        )
        progress.watch(spark, query, path, 0.2)
        assert progress.keep_progress(spark, query, path) == 0

    run("first")
    kept = progress.kept_progress(spark, path)
    fed = kept.where("input_rows > 0")
    assert fed.count() == 5 and fed.agg(F.sum("input_rows"), F.sum("late_rows")).first() == (5, 1)
    assert kept.select("batch").distinct().count() == kept.count()
    put_files(folder, [line("00:40:00.000"), line("00:00:01.000")], start=5)
    run("second")
    kept = progress.kept_progress(spark, path)
    assert kept.select("query_id").distinct().count() == 1 and kept.select("run_id").distinct().count() == 2
    assert kept.agg(F.sum("input_rows"), F.sum("late_rows")).first() == (7, 2)


def test_open_windows_of_a_stopped_query(spark, tmp_path):
    folder = str(tmp_path / "in")
    put_files(folder, WATERMARK_CASE)
    checkpoint = str(tmp_path / "checkpoint")
    stream = messages.line_stream(spark, folder)
    sinks.start_files(jobs.errors_per_second(stream), str(tmp_path / "out"), checkpoint).awaitTermination()
    found = progress.open_windows(spark, checkpoint)
    assert found.columns == ["start", "end", "count"]
    assert [clock(r) for r in found.collect()] == [("00:30:00", 1)]
