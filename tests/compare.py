"""Compare queries with their SQL: ``python tests/compare.py [folder] [query ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def family(type_name: str) -> str:
    """One name for the types that both sides spell differently."""
    same = {
        "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    }
    return same.get(type_name, type_name)


def mismatch(df, relation) -> str | None:
    """What differs between a Spark result and an oracle result, or None."""
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return f"columns {names} against {sorted(relation.columns)}"
    types = dict(zip(relation.columns, map(str, relation.types)))
    for name, spark_type in df.dtypes:
        if family(spark_type) != types[name]:
            return f"type of {name}: {spark_type} against {types[name]}"
    got = sorted(map(repr, (tuple(row) for row in df.select(*names).collect())))
    quoted = ", ".join(f'"{name}"' for name in names)
    want = sorted(map(repr, relation.project(quoted).fetchall()))
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for ours, theirs in zip(got, want):
        if ours != theirs:
            return f"{ours[:300]} against {theirs[:300]}"
    return None if got else "no rows"


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(oracle_sql())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = oracle(sf_dir)
    bad = 0
    for name in chosen:
        started = time.time()
        try:
            problem = mismatch(
                queries()[name](spark, sf_dir), connection.sql(oracle_sql()[name])
            )
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        mark, took = "FAIL" if problem else "ok", time.time() - started
        print(f"{mark:5}{took:7.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
