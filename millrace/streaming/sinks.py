"""Starting, watching and stopping stream queries."""

from __future__ import annotations

import io
from collections.abc import Sequence
from contextlib import redirect_stdout

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from millrace.workspace import fresh_name, fresh_path, settings

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
# Keeps state off the heap and on local disk, backed by the checkpoint.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WIDTH = "spark.sql.shuffle.partitions"


def state_partitions(spark: SparkSession) -> int:
    """Partitions for stream state: the session's shuffle width.

    Every batch runs a task for each, and the number is fixed by the first run of a
    checkpoint, so state that grows wants a width for its later size; ``partitions`` of a
    query overrides it.
    """
    return int(spark.conf.get(WIDTH))


def stream_settings(spark: SparkSession, partitions: int | None) -> dict[str, str]:
    """Settings a query takes over when it starts."""
    return {
        WIDTH: str(partitions or state_partitions(spark)),
        STATE_STORE: ROCKSDB,
        # Each batch uploads its changes, not whole snapshots.
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # Sessions of a busy key are joined within each task before the shuffle.
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }


def start_memory(
    df: DataFrame,
    name: str,
    checkpoint: str,
    mode: str = "complete",
    every: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Stream into the in-memory table ``name`` of the session, for small results only.

    Batches follow each other every ``every``; without it all available input
    is processed and the query ends.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    spark = df.sparkSession
    with settings(spark, stream_settings(spark, partitions)):
        return (
            df.writeStream.format("memory")
            .queryName(name)
            .outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )


def start_table(
    df: DataFrame,
    table: str,
    checkpoint: str,
    path: str | None = None,
    every: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet catalog table, each input row once."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    spark = df.sparkSession
    writer = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    if path:
        writer = writer.option("path", path)
    with settings(spark, stream_settings(spark, partitions)):
        return writer.toTable(table)


def start_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    every: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Append a stream to Parquet files below ``path``, each input row once.

    Readers of the folder see the rows of finished batches only.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    spark = df.sparkSession
    writer = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .partitionBy(*partition_by)
        .trigger(**trigger)
    )
    with settings(spark, stream_settings(spark, partitions)):
        return writer.start()


def run_to_memory(df: DataFrame, mode: str = "complete") -> DataFrame:
    """Process what is available and give the in-memory table."""
    spark = df.sparkSession
    name = fresh_name("stream")
    start_memory(df, name, fresh_path(spark, "checkpoint"), mode).awaitTermination()
    return spark.table(name)


def run_to_table(df: DataFrame) -> DataFrame:
    """Process what is available into a new table in the shared folder and give it."""
    spark = df.sparkSession
    name = fresh_name("stream")
    query = start_table(df, name, fresh_path(spark, "checkpoint"), fresh_path(spark, "stream"))
    query.awaitTermination()
    return spark.table(name)


def query_facts(query: StreamingQuery) -> dict:
    """Name, status, last progress and plan of the last batch of a stream query."""
    plan = io.StringIO()
    with redirect_stdout(plan):
        query.explain()
    return {
        "plan": plan.getvalue(),
        "name": query.name,
        "active": query.isActive,
        "status": query.status,
        "last_progress": query.lastProgress,
    }


def stop_all(spark: SparkSession) -> None:
    """Stop every running stream query of the session."""
    for query in spark.streams.active:
        query.stop()
