"""Queries of event-time windows, over tables and over streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators.summaries import count_by
from millrace.plans.catalogue import query, table
from millrace.plans.renderings import (
    edit_messages,
    in_envelopes,
    log_lines,
    stored_lines,
    tweet_messages,
)
from millrace.sources import drift
from millrace.sources.ingest import json_file_stream
from millrace.sources.messages import (
    file_stream,
    line_stream,
    replay_messages,
    with_text_value,
)
from millrace.streaming import jobs, progress, sinks, topk, windows
from millrace.workspace import fresh_name, fresh_path, materialize


def without_zone(df, *names):
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def event_stream(spark, sf_dir):
    """The events table as a stream, its time as an instant, which watermarks need."""
    # A pattern, so that the table may be one file or a folder of files.
    path = f"{sf_dir}/events.parquet*"
    stream = file_stream(spark, path, table(spark, sf_dir, "events").schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


HOURLY_SQL = """
    SELECT date_trunc('hour', ts) AS start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS "end",
           event_type, COUNT(*) AS count
    FROM events GROUP BY ALL
"""


@query("""
    SELECT date_trunc('hour', ts) AS start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS "end",
           event_type, COUNT(*) AS count,
           CAST(SUM(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS k_sum
    FROM events GROUP BY ALL
""")
def hourly_activity(spark, sf_dir):
    """Parsed JSON properties, counted and summed per hour and event type."""
    parsed = table(spark, sf_dir, "events").select(
        "ts", "event_type", F.from_json("props", "k int").alias("json")
    )
    hours = parsed.groupBy(F.window("ts", "1 hour").alias("window"), "event_type").agg(
        F.count("*").alias("count"), F.sum("json.k").alias("k_sum")
    )
    return hours.select("window.start", "window.end", "event_type", "count", "k_sum")


@query(HOURLY_SQL)
def tumbling_count(spark, sf_dir):
    return windows.window_count(
        table(spark, sf_dir, "events"), "ts", "1 hour", keys=["event_type"]
    )


@query("""
    WITH placed AS (
        SELECT event_type,
               unnest([time_bucket(INTERVAL 30 MINUTE, ts),
                       time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS start
        FROM events)
    SELECT start, start + INTERVAL 1 HOUR AS "end", event_type, COUNT(*) AS count
    FROM placed GROUP BY ALL
""")
def sliding_count(spark, sf_dir):
    return windows.window_count(
        table(spark, sf_dir, "events"), "ts", "1 hour", "30 minutes", ["event_type"]
    )


SESSION_SQL = """
    WITH marked AS (
        SELECT user_id, ts, CASE WHEN ts <= lag(ts) OVER w + INTERVAL {gap} THEN 0 ELSE 1 END AS new
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    numbered AS (
        SELECT user_id, ts, SUM(new) OVER (PARTITION BY user_id ORDER BY ts) AS session
        FROM marked)
    SELECT user_id, min(ts) AS start, max(ts) + INTERVAL {gap} AS "end", COUNT(*) AS count
    FROM numbered GROUP BY user_id, session
"""


@query(SESSION_SQL.format(gap="6 HOUR"))
def session_count(spark, sf_dir):
    return windows.session_count(table(spark, sf_dir, "events"), "ts", "6 hours", ["user_id"])


@query("""
    SELECT date_trunc('second', ts) AS start, date_trunc('second', ts) + INTERVAL 1 SECOND AS "end",
           COUNT(*) AS count
    FROM events WHERE event_type = 'error' GROUP BY ALL
""")
def log_errors_per_second(spark, sf_dir):
    lines = log_lines(table(spark, sf_dir, "events"))
    return without_zone(jobs.errors_per_second(lines), "start", "end")


EDITS_SQL = """
    WITH anonymous AS (
        SELECT date_trunc('second', ts) AS t, 'C' || (user_id % 20) AS "countryCode3"
        FROM events
        WHERE event_type IN ('click', 'view') AND value > 5 AND value <= 50),
    placed AS (
        SELECT "countryCode3", unnest([t, t - INTERVAL 500 MILLISECOND]) AS start FROM anonymous)
    SELECT start, start + INTERVAL 1 SECOND AS "end", "countryCode3", COUNT(*) AS count
    FROM placed
"""


@query(EDITS_SQL + " GROUP BY ALL")
def edits_sliding(spark, sf_dir):
    messages = edit_messages(table(spark, sf_dir, "events"))
    return without_zone(jobs.anonymous_edits_per_country(messages), "start", "end")


HASHTAG_SQL = """
    SELECT lower(tag) AS "hashTag", COUNT(*) AS count
    FROM (SELECT unnest(string_split(text, ' ')) AS tag FROM documents)
    GROUP BY lower(tag) ORDER BY count DESC, "hashTag" LIMIT 30
"""


@query(HASHTAG_SQL)
def hashtag_topk(spark, sf_dir):
    return jobs.popular_hashtags(tweet_messages(table(spark, sf_dir, "documents")))


@query("""
    SELECT start, start + INTERVAL 28 DAY AS "end", event_type, COUNT(*) AS count
    FROM (SELECT time_bucket(INTERVAL 28 DAY, date_trunc('milliseconds', ts), TIMESTAMP '1970-01-01') AS start,
                 event_type FROM events)
    GROUP BY start, event_type
""")
def stream_tumbling_complete(spark, sf_dir):
    """Complete mode: the in-memory table holds a row per type for each four weeks of time,
    however many events there are."""
    counted = windows.window_count(event_stream(spark, sf_dir), "ts", "28 days", keys=["event_type"])
    return without_zone(sinks.run_to_memory(counted.orderBy("start")), "start", "end")


@query("SELECT event_type, COUNT(*) AS count FROM events GROUP BY event_type")
def stream_stopped(spark, sf_dir):
    """Batches by the clock until all input is in; then stopped, and read by SQL."""
    name = fresh_name("stream")
    counts = count_by(event_stream(spark, sf_dir), ["event_type"])
    running = sinks.start_memory(counts, name, fresh_path(spark, "checkpoint"), every="200 milliseconds")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.sql(f"SELECT event_type, count FROM {name}")


@query(f"""
    SELECT * FROM ({HOURLY_SQL})
    WHERE "end" <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY FROM events)
""")
def stream_watermark_append(spark, sf_dir):
    """Append mode gives a window once the watermark has passed its end."""
    stream = event_stream(spark, sf_dir).withWatermark("ts", "1 day")
    counted = windows.window_count(stream, "ts", "1 hour", keys=["event_type"])
    return without_zone(sinks.run_to_table(counted), "start", "end")


@query(f"""
    SELECT * FROM ({SESSION_SQL.format(gap="6 HOUR")})
    WHERE "end" <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY FROM events)
""")
def stream_sessions(spark, sf_dir):
    stream = event_stream(spark, sf_dir).withWatermark("ts", "1 day")
    counted = windows.session_count(stream, "ts", "6 hours", ["user_id"])
    return without_zone(sinks.run_to_table(counted), "start", "end")


@query("SELECT COUNT(*) AS count FROM events")
def stream_running_count(spark, sf_dir):
    return sinks.run_to_memory(jobs.running_count(event_stream(spark, sf_dir)))


@query("""
    WITH seconds AS (
        SELECT date_trunc('second', ts) AS start FROM events WHERE event_type = 'error')
    SELECT start, start + INTERVAL 1 SECOND AS "end", COUNT(*) AS count FROM seconds
    WHERE start + INTERVAL 1 SECOND <= (SELECT max(start) - INTERVAL 1 MINUTE FROM seconds)
    GROUP BY ALL
""")
def stream_log_errors(spark, sf_dir):
    path = stored_lines(log_lines(table(spark, sf_dir, "events")), "log-lines")
    counted = jobs.errors_per_second(line_stream(spark, path))
    return without_zone(sinks.run_to_table(counted), "start", "end")


@query(EDITS_SQL + """
    WHERE start + INTERVAL 1 SECOND <= (SELECT max(t) - INTERVAL 1 MINUTE FROM anonymous)
    GROUP BY ALL
""")
def stream_edits_sliding(spark, sf_dir):
    path = stored_lines(edit_messages(table(spark, sf_dir, "events")), "edits")
    counted = jobs.anonymous_edits_per_country(line_stream(spark, path), delay="1 minute")
    return without_zone(sinks.run_to_table(counted), "start", "end")


@query(HASHTAG_SQL)
def stream_topk(spark, sf_dir):
    """Complete mode, since a stream cannot be sorted otherwise; 30 rows in memory."""
    path = fresh_path(spark, "tweets")
    tweets = tweet_messages(table(spark, sf_dir, "documents"))
    in_envelopes(tweets, "tweets").write.parquet(path)
    stream = with_text_value(replay_messages(spark, path, subscribe="tweets"))
    return sinks.run_to_memory(jobs.popular_hashtags(stream))


@query("""
    SELECT event_id, date_trunc('milliseconds', ts) AS ts, user_id, event_type, value, props,
           true AS has_lineage
    FROM events
""")
def file_ingest(spark, sf_dir):
    """JSON files taken in once each, though the query runs twice."""
    path, checkpoint = fresh_path(spark, "event-files"), fresh_path(spark, "checkpoint")
    target, location = fresh_name("ingested"), fresh_path(spark, "ingested")
    table(spark, sf_dir, "events").write.json(path)
    for _ in range(2):
        stream = json_file_stream(spark, path, f"{checkpoint}-schema")
        sinks.start_table(stream, target, checkpoint, location).awaitTermination()
    lineage = F.col("source_file").contains("event-files") & F.col("processing_time").isNotNull()
    return spark.table(target).select(
        "event_id", F.date_trunc("millisecond", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("ts"),
        "user_id", "event_type", "value", "props", lineage.alias("has_lineage"),
    )


DRIFT_STAGES = 3


def drifting_lines(events, stage):
    """One delivery of events as JSON lines: later ones add and retype fields; some lines are cut."""
    amount = F.floor("value")
    fields = [
        F.col("event_id"),
        F.col("event_type") if stage < 2 else F.array("event_type").alias("event_type"),
        (amount, amount + F.lit(0.5), F.concat(F.lit("about "), amount.cast("string")))[stage].alias("amount"),
    ]
    if stage > 0:
        fields.append(F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    if stage > 1:
        fields.append(F.struct("user_id").alias("who"))
    line = F.to_json(F.struct(*fields))
    cut = F.when(F.col("event_id") % 7 == 0, line.substr(F.lit(1), F.length(line) - 1)).otherwise(line)
    return events.where(F.col("event_id") % DRIFT_STAGES == stage).select(cut.alias("value"))


@query("""
    WITH lines AS (
        SELECT event_id, event_id % 3 AS stage, event_id % 7 = 0 AS cut, user_id,
               CASE event_id % 3 WHEN 2 THEN '["' || event_type || '"]' ELSE event_type END AS event_type,
               CAST(floor(value) AS BIGINT)::VARCHAR AS whole,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events),
    shown AS (
        SELECT event_id, stage, cut, event_type, user_id,
               CASE stage WHEN 0 THEN whole WHEN 1 THEN whole || '.5' ELSE 'about ' || whole END AS amount,
               CASE WHEN stage > 0 THEN k END AS k,
               CASE WHEN stage > 1 THEN '{"user_id":' || user_id || '}' END AS who
        FROM lines)
    SELECT CASE WHEN NOT cut THEN event_id END AS event_id, CASE WHEN NOT cut THEN event_type END AS event_type,
           CASE WHEN NOT cut THEN amount END AS amount, CASE WHEN NOT cut THEN k END AS k,
           CASE WHEN NOT cut THEN who END AS who, CAST(NULL AS VARCHAR) AS rescued,
           CASE WHEN cut THEN
               '{"event_id":' || event_id || ',"event_type":' ||
               CASE WHEN stage < 2 THEN '"' || event_type || '"' ELSE event_type END || ',"amount":' ||
               CASE WHEN stage < 2 THEN amount ELSE '"' || amount || '"' END ||
               CASE WHEN k IS NOT NULL THEN ',"k":' || k ELSE '' END || coalesce(',"who":' || who, '')
           END AS broken,
           CASE stage WHEN 2 THEN 2 ELSE 1 END AS written_under
    FROM shown
""")
def drifting_ingest(spark, sf_dir):
    """Three deliveries, each taken in by a new start, and a start after them; read under the last schema."""
    events = table(spark, sf_dir, "events")
    root = fresh_path(spark, "drift")
    path, target, checkpoint, store = (f"{root}/{part}" for part in ("lines", "rows", "checkpoint", "schemas"))
    for stage in range(DRIFT_STAGES + 1):
        if stage < DRIFT_STAGES:
            drifting_lines(events, stage).write.mode("append").text(path)
        drift.start_ingest(spark, path, target, checkpoint, store).awaitTermination()
    rows = drift.read_ingested(spark, target, store)
    return rows.drop("source_file", "processing_time").withColumnRenamed(drift.VERSION, "written_under")


TOP_TAGS, TAG_WINDOW = 10, "1 minute"


@query(f"""
    WITH placed AS (
        SELECT epoch_ms(doc_id * 1000 + 1) AS t, time_bucket(INTERVAL 1 MINUTE, epoch_ms(doc_id * 1000 + 1)) AS start,
               lower(unnest(string_split(text, ' '))) AS tag
        FROM documents),
    counted AS (SELECT start, tag, COUNT(*) AS count FROM placed GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY start ORDER BY count DESC, tag) AS rank FROM counted)
    SELECT start, start + INTERVAL 1 MINUTE AS "end", CAST(rank AS INTEGER) AS rank, tag, count FROM ranked
    WHERE rank <= {TOP_TAGS}
      AND start + INTERVAL 1 MINUTE <= (SELECT max(t) - INTERVAL 1 MINUTE FROM placed)
""")
def stream_topk_windows(spark, sf_dir):
    """Most frequent hashtags of closed windows: one sketch a window as state, then an exact count."""
    path = stored_lines(tweet_messages(table(spark, sf_dir, "documents")), "tweets")
    tweets = jobs.tweets(line_stream(spark, path), ["hashTags", "createdAt"])
    tags = tweets.select("time", F.explode("hashTags").alias("hashTag")).select("time", F.lower("hashTag").alias("tag"))
    folder = fresh_path(spark, "top-tags")
    for running in topk.start_topk(tags, "time", "tag", TAG_WINDOW, "1 minute", folder):
        running.awaitTermination()
    return without_zone(topk.read_topk(spark, folder, "time", "tag", TAG_WINDOW, TOP_TAGS), "start", "end")


DELIVERIES = 4
DELIVERED_SQL = f"SELECT *, CAST(event_id % {DELIVERIES} AS INTEGER) AS delivery FROM events"


@query(f"""
    WITH delivered AS ({DELIVERED_SQL}),
    reached AS (SELECT delivery, date_trunc('milliseconds', max(ts)) AS t FROM delivered GROUP BY delivery),
    marks AS (
        SELECT a.delivery, max(b.t) - INTERVAL 1 DAY AS mark
        FROM reached a LEFT JOIN reached b ON b.delivery < a.delivery GROUP BY a.delivery)
    SELECT delivery, COUNT(*) AS input_rows, COUNT(*) FILTER (ts <= mark) AS late_rows
    FROM delivered JOIN marks USING (delivery) GROUP BY delivery
""")
def stream_progress(spark, sf_dir):
    """Deliveries that overlap in time: rows that come behind the watermark are dropped, and the kept
    progress says how many."""
    root = fresh_path(spark, "deliveries")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for delivery in range(DELIVERIES):
        events.where(F.col("event_id") % DELIVERIES == delivery).write.mode("append").parquet(f"{root}/in")
        stream = file_stream(spark, f"{root}/in", events.schema).withWatermark("ts", "1 day")
        distinct = stream.dropDuplicates(["event_id", "ts"])
        running = sinks.start_files(distinct, f"{root}/out", f"{root}/checkpoint")
        progress.watch(spark, running, f"{root}/progress")
    kept = progress.kept_progress(spark, f"{root}/progress").where("input_rows > 0")
    # A row a batch, so the window over all of them is small.
    delivery = (F.row_number().over(Window.orderBy("batch")) - 1).alias("delivery")
    return kept.select(delivery, "input_rows", "late_rows")


STATE_SQL = """
    SELECT '{point}' AS point, start, start + INTERVAL 28 DAY AS "end", event_type, COUNT(*) AS count
    FROM (SELECT time_bucket(INTERVAL 28 DAY, date_trunc('milliseconds', ts), TIMESTAMP '1970-01-01') AS start,
                 event_type FROM events WHERE {part})
    WHERE start + INTERVAL 28 DAY {state} (
        SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY FROM events WHERE {part})
    GROUP BY start, event_type
"""
HALF = "event_id < (SELECT COUNT(*) / 2 FROM events)"


@query(" UNION ALL ".join([
    STATE_SQL.format(point="open half way", part=HALF, state=">"),
    STATE_SQL.format(point="open at the end", part="true", state=">"),
    STATE_SQL.format(point="given", part="true", state="<="),
]))
def stream_state(spark, sf_dir):
    """A query that stops half way, its open windows read out of the checkpoint, and its restart."""
    root = fresh_path(spark, "stopped")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first = F.col("event_id") < events.count() / 2
    found = []
    for point, part in (("open half way", first), ("open at the end", ~first)):
        events.where(part).write.mode("append").parquet(f"{root}/in")
        stream = file_stream(spark, f"{root}/in", events.schema).withWatermark("ts", "1 day")
        counted = windows.window_count(stream, "ts", "28 days", keys=["event_type"])
        sinks.start_files(counted, f"{root}/out", f"{root}/checkpoint").awaitTermination()
        state = progress.open_windows(spark, f"{root}/checkpoint").select("start", "end", "event_type", "count")
        found.append(materialize(state.withColumn("point", F.lit(point)), "open-windows"))
    given = spark.read.parquet(f"{root}/out").withColumn("point", F.lit("given"))
    return without_zone(found[0].unionByName(found[1]).unionByName(given.select(found[0].columns)), "start", "end")
