"""Stream sources: text lines, message envelopes, and topic selection."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ENVELOPE = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)


def one_topic_choice(
    subscribe: str | Sequence[str] | None,
    assign: Mapping[str, Sequence[int]] | None,
    subscribe_pattern: str | None,
) -> None:
    given = [choice for choice in (subscribe, assign, subscribe_pattern) if choice is not None]
    if len(given) != 1:
        raise ValueError("give exactly one of subscribe, assign and subscribe_pattern")


def topic_names(subscribe: str | Sequence[str]) -> list[str]:
    names = subscribe.split(",") if isinstance(subscribe, str) else list(subscribe)
    return [name.strip() for name in names]


def kafka_options(
    servers: str,
    subscribe: str | Sequence[str] | None = None,
    assign: Mapping[str, Sequence[int]] | None = None,
    subscribe_pattern: str | None = None,
    max_offsets_per_trigger: int | None = None,
    starting_offsets: str | None = None,
) -> dict[str, str]:
    """Reader options for a Kafka stream."""
    one_topic_choice(subscribe, assign, subscribe_pattern)
    options = {"kafka.bootstrap.servers": servers}
    if subscribe is not None:
        options["subscribe"] = ",".join(topic_names(subscribe))
    if assign is not None:
        options["assign"] = json.dumps({topic: list(parts) for topic, parts in assign.items()})
    if subscribe_pattern is not None:
        options["subscribePattern"] = subscribe_pattern
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if starting_offsets is not None:
        options["startingOffsets"] = starting_offsets
    return options


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A Kafka stream; the session needs Spark's Kafka connector on its class path."""
    return spark.readStream.format("kafka").options(**options).load()


def in_topics(
    subscribe: str | Sequence[str] | None = None,
    assign: Mapping[str, Sequence[int]] | None = None,
    subscribe_pattern: str | None = None,
) -> Column:
    """The same choice as a filter over stored envelopes, so that a replay can prune."""
    one_topic_choice(subscribe, assign, subscribe_pattern)
    topic, partition = F.col("topic"), F.col("partition")
    if subscribe is not None:
        return topic.isin(topic_names(subscribe))
    if subscribe_pattern is not None:
        return topic.rlike(f"^(?:{subscribe_pattern})$")
    chosen = F.lit(False)
    for name, parts in assign.items():
        chosen = chosen | ((topic == name) & partition.isin(list(parts)))
    return chosen


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A stream over the files of a folder, each file once."""
    reader = spark.readStream.schema(schema).format(format)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def replay_messages(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    **topics,
) -> DataFrame:
    """Stored message envelopes as a stream, from the first one on.

    The number of files per trigger throttles it; a new checkpoint rewinds it.
    """
    stream = file_stream(spark, path, ENVELOPE, max_files_per_trigger=max_files_per_trigger)
    return stream.filter(in_topics(**topics))


def line_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Text files as a stream with one ``value`` per line."""
    return file_stream(
        spark, path, "value string", format="text", max_files_per_trigger=max_files_per_trigger
    )


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket as a stream, for trials only: lost input does not come back."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def with_text_value(df: DataFrame) -> DataFrame:
    """The message time and the payload as text."""
    return df.select("timestamp", F.col("value").cast("string").alias("value"))
