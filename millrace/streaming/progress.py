"""Progress of stream queries as a table, and the state of a stopped one.

Progress is taken from the query itself, which remembers its last batches; a listener in Python
would open a port for calls back from the JVM.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

PROGRESS = """
    query_id string, run_id string, batch bigint, started string, input_rows bigint, watermark string,
    operator int, operator_name string, state_rows bigint, updated_rows bigint, late_rows bigint, state_bytes bigint
"""


def progress_rows(query: StreamingQuery) -> list[tuple]:
    """A row for each remembered batch and stateful operator; one without operator if there is none."""
    rows = []
    for progress in query.recentProgress:
        facts = json.loads(progress.json)
        batch = (
            facts["id"], facts["runId"], facts["batchId"], facts["timestamp"],
            sum(source["numInputRows"] for source in facts["sources"]), facts.get("eventTime", {}).get("watermark"),
        )
        operators = facts["stateOperators"] or [None]
        for number, operator in enumerate(operators):
            state = (None,) * 6 if operator is None else (
                number, operator["operatorName"], operator["numRowsTotal"], operator["numRowsUpdated"],
                operator["numRowsDroppedByWatermark"], operator["memoryUsedBytes"],
            )
            rows.append((*batch, *state))
    return rows


def kept_progress(spark: SparkSession, path: str) -> DataFrame:
    """All progress kept at ``path``; no rows before the first batch was kept."""
    try:
        return spark.read.schema(PROGRESS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PROGRESS)


def keep_progress(spark: SparkSession, query: StreamingQuery, path: str) -> int:
    """Add the batches that are not kept yet to the table at ``path``; gives the number of rows."""
    last = kept_progress(spark, path).where(F.col("run_id") == str(query.runId)).agg(F.max("batch")).first()[0]
    fresh = [row for row in progress_rows(query) if last is None or row[2] > last]
    if fresh:
        spark.createDataFrame(fresh, PROGRESS).coalesce(1).write.mode("append").parquet(path)
    return len(fresh)


def watch(spark: SparkSession, query: StreamingQuery, path: str, every: float = 10) -> None:
    """Keep the progress of a query until it ends, looking every so many seconds.

    A query remembers ``spark.sql.streaming.numRecentProgressUpdates`` batches, 100 if not set;
    ``every`` should be shorter than those take.
    """
    ended = False
    while not ended:
        ended = query.awaitTermination(every)
        keep_progress(spark, query, path)


def open_windows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The windows that a stopped query of one windowed aggregation holds in its checkpoint:
    ``start``, ``end``, the other keys and the aggregated values."""
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    keys = [name for name in state.schema["key"].dataType.names if name != "window"]
    return state.select(
        "key.window.start", "key.window.end", *[F.col(f"key.`{name}`") for name in keys], "value.*"
    )
