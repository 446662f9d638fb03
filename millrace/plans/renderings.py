"""The given tables rendered as the texts and messages that the jobs read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.jsontext import as_message
from millrace.functions.scalars import LOG_MILLIS, PLAIN_ISO, ZONED_ISO_MILLIS
from millrace.workspace import fresh_path


def log_lines(events: DataFrame) -> DataFrame:
    """Events as log lines; error events become error lines."""
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    return events.select(
        F.format_string(
            "[%s] (%s) user %d sent event %d",
            F.date_format("ts", LOG_MILLIS),
            level,
            "user_id",
            "event_id",
        ).alias("value")
    )


def edit_messages(events: DataFrame) -> DataFrame:
    """Events as article edits in JSON text."""
    user = F.col("user_id")
    country = F.when(F.col("value") <= 50, F.concat(F.lit("C"), (user % 20).cast("string")))
    return as_message(
        events.select(
            F.lit("en").alias("wikipedia"),
            F.when(F.col("event_type").isin("click", "view"), "article")
            .otherwise("talk")
            .alias("namespace"),
            (F.col("value") > 5).alias("isAnonymous"),
            F.concat(F.lit("page-"), F.col("event_id").cast("string")).alias("page"),
            user.cast("string").alias("user"),
            F.struct(country.alias("countryCode3")).alias("geocoding"),
            F.date_format(F.col("ts").cast("timestamp"), ZONED_ISO_MILLIS).alias("timestamp"),
        )
    )


def tweet_messages(documents: DataFrame) -> DataFrame:
    """Documents as tweets in JSON text; every word is a hashtag."""
    return as_message(
        documents.select(
            F.split("text", " ").alias("hashTags"),
            F.col("doc_id").alias("id"),
            (F.col("doc_id") * 1000 + 1).alias("createdAt"),
            "lang",
        )
    )


def envelopes(events: DataFrame) -> DataFrame:
    """Events as message envelopes: one topic per type, four partitions."""
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def in_envelopes(messages: DataFrame, topic: str) -> DataFrame:
    """Message texts as envelopes of one topic."""
    return messages.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.spark_partition_id().alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.timestamp_seconds(F.lit(0)).alias("timestamp"),
    )


def page_view_rows(events: DataFrame) -> DataFrame:
    """Events as page-view rows of text time, site and requests."""
    return events.select(
        F.date_format("ts", PLAIN_ISO).alias("timestamp"),
        F.col("event_type").alias("site"),
        F.floor("value").cast("int").alias("requests"),
    )


def stored_lines(df: DataFrame, label: str) -> str:
    """Write a single text column to fresh text files; gives their folder."""
    path = fresh_path(df.sparkSession, label)
    df.write.text(path)
    return path
