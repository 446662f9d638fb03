"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from millrace.workspace import settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must agree with it.

    Texts without a zone are UTC in every query.
    """

    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Expressions take the zone over when they are resolved, which is as they are built.
            with settings(spark, {"spark.sql.session.timeZone": "UTC"}):
                return build(spark, sf_dir)

        QUERIES[build.__name__] = run
        if oracle is not None:
            ORACLES[build.__name__] = oracle
        return run

    return register


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
