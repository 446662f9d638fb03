"""Jobs over log lines, article edits and tweets; each takes a table or a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.jsontext import parsed_rows
from millrace.functions.scalars import (
    LOG_MILLIS,
    ZONED_ISO_MILLIS,
    from_epoch_millis,
    parse_ts,
)
from millrace.operators.summaries import top_counts
from millrace.streaming.windows import window_count

# The fields of the messages, and the parts of a log line.
EDIT_SCHEMA = """
    channel string, comment string, delta int, flag string,
    geocoding struct<
        city: string, country: string, countryCode2: string, countryCode3: string,
        stateProvince: string, latitude: double, longitude: double>,
    isAnonymous boolean, isNewPage boolean, isRobot boolean, isUnpatrolled boolean,
    namespace string, page string, pageURL string, timestamp string, url string,
    user string, userURL string, wikipediaURL string, wikipedia string
"""
TWEET_SCHEMA = """
    hashTags array<string>, text string, userScreenName string, id bigint,
    createdAt bigint, retweetCount int, lang string, favoriteCount int, user string,
    place struct<
        coordinates: string, name: string, placeType: string, fullName: string,
        countryCode: string>
"""
EDIT_FIELDS = (
    "wikipedia", "isAnonymous", "namespace", "page", "pageURL", "geocoding", "timestamp", "user"
)
LOG_BODY = r"^.*\]\s+(.*)$"
LOG_ERROR = "% (ERROR) %"
TIME_START, TIME_LENGTH = 2, 23


def log_records(lines: DataFrame) -> DataFrame:
    """Log lines to ``capturedAt`` and ``logData``."""
    return lines.select(
        parse_ts(F.col("value").substr(TIME_START, TIME_LENGTH), LOG_MILLIS).alias("capturedAt"),
        F.regexp_extract("value", LOG_BODY, 1).alias("logData"),
    )


def log_errors(lines: DataFrame) -> DataFrame:
    """The records of error lines; other lines go before anything is parsed."""
    return log_records(lines.filter(F.col("value").like(LOG_ERROR)))


def errors_per_second(
    lines: DataFrame, delay: str | None = "1 minute", width: str = "1 second"
) -> DataFrame:
    """Error lines per window of capture time."""
    errors = log_errors(lines)
    if errors.isStreaming and delay:
        errors = errors.withWatermark("capturedAt", delay)
    return window_count(errors, "capturedAt", width)


def edits(messages: DataFrame) -> DataFrame:
    """Article edits out of the JSON text in ``value``."""
    rows = parsed_rows(messages.select("value"), "value", EDIT_SCHEMA, EDIT_FIELDS)
    return rows.withColumn("timestamp", parse_ts("timestamp", ZONED_ISO_MILLIS))


def anonymous_edits(messages: DataFrame) -> DataFrame:
    """Edits of articles without a login whose country is known."""
    return edits(messages).filter(
        (F.col("namespace") == "article")
        & F.col("isAnonymous")
        & F.col("geocoding.countryCode3").isNotNull()
    )


def anonymous_edits_per_country(
    messages: DataFrame,
    delay: str | None = None,
    width: str = "1 second",
    slide: str = "500 milliseconds",
) -> DataFrame:
    """Anonymous edits per country in sliding windows."""
    anonymous = anonymous_edits(messages)
    if anonymous.isStreaming and delay:
        anonymous = anonymous.withWatermark("timestamp", delay)
    country = F.col("geocoding.countryCode3").alias("countryCode3")
    return window_count(anonymous, "timestamp", width, slide, [country])


def tweets(messages: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Tweets out of the JSON text in ``value``, fields flattened, ``createdAt`` also as time."""
    rows = parsed_rows(messages.select("value"), "value", TWEET_SCHEMA, fields)
    if "createdAt" not in rows.columns:
        return rows
    return rows.select(from_epoch_millis("createdAt").alias("time"), "*")


def popular_hashtags(messages: DataFrame, k: int = 30) -> DataFrame:
    """The most frequent hashtags in lower case."""
    tags = tweets(messages, ["hashTags"]).select(F.explode("hashTags").alias("hashTag"))
    return top_counts(tags.select(F.lower("hashTag").alias("hashTag")), ["hashTag"], k)


def running_count(df: DataFrame) -> DataFrame:
    """Rows so far."""
    return df.agg(F.count("*").alias("count"))
