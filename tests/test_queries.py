"""Every query against its SQL counterpart, its plan, and other input partitions."""

from __future__ import annotations

import inspect
import os
import subprocess
import sys

import pytest
from compare import mismatch

from __spark_entry__ import entry
from __spark_entry__ import queries as registered
from millrace.workspace import settings
from millrace.plans import ORACLES, QUERIES, array_queries, nested_queries, stream_queries, table_queries

ALL = sorted(QUERIES)


def queries():
    return QUERIES


def oracle_sql():
    return ORACLES


@pytest.mark.parametrize("name", ALL)
def test_agrees_with_sql(spark, small, duck, name):
    df = queries()[name](spark, small)
    assert mismatch(df, duck.sql(oracle_sql()[name])) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for python_step in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonMapInArrow"):
        assert python_step not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(registered())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["start", "end", "event_type", "count", "k_sum"]
    assert df.count() > 0


def reading_tables():
    """Queries that only read tables, by the module whose reader can be replaced."""
    skipped = {"generated_arrays", "file_ingest", "unique_ids", "drifting_ingest"}
    for module in (array_queries, nested_queries, table_queries, stream_queries):
        for name, function in inspect.getmembers(module, inspect.isfunction):
            if name in queries() and name not in skipped and not name.startswith("stream_"):
                yield module, name


@pytest.mark.parametrize("parts", [1, 7, 16])
def test_same_result_for_other_partitions(spark, small, duck, monkeypatch, parts):
    for module, name in reading_tables():
        read = module.table
        monkeypatch.setattr(
            module, "table", lambda s, d, t, read=read: read(s, d, t).repartition(parts)
        )
        df = queries()[name](spark, small)
        assert mismatch(df, duck.sql(oracle_sql()[name])) is None, name
        monkeypatch.setattr(module, "table", read)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_are_pruned_and_pushed(spark, small):
    plan = plan_text(queries()["hourly_activity"](spark, small))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in plan
    assert plan.count("Exchange") == 1
    assert "TakeOrderedAndProject" in plan_text(queries()["topk_keys"](spark, small))
    assert "EqualTo(o_orderstatus,F)" in plan_text(queries()["filter_eq"](spark, small))
    assert "Exchange rangepartitioning" in plan_text(queries()["sort_multi"](spark, small))
    assert "Exchange" not in plan_text(queries()["sort_within"](spark, small))
    assert plan_text(queries()["edits_sliding"](spark, small)).count("from_json") == 1
    assert plan_text(queries()["hashtag_topk"](spark, small)).count("from_json") == 1


@pytest.mark.parametrize(
    "name", [n for n, f in inspect.getmembers(array_queries, inspect.isfunction) if n in queries()]
)
def test_array_queries_move_no_rows(spark, small, name):
    assert "Exchange" not in plan_text(queries()[name](spark, small))


@pytest.mark.parametrize("absent", ["xxhash", "tiktoken", "public_tokenizers"])
def test_other_queries_stay_without_a_library_of_the_corpus_part(absent):
    """Where the corpus part is installed but cannot be imported, the catalogue is complete without it."""
    script = (
        f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e;"
        "from millrace.plans import QUERIES; assert set(QUERIES) <= set(e.queries());"
        "assert set(e.oracle_sql()) <= set(e.queries())"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", script], cwd=root, check=True, timeout=120)


def test_queries_leave_the_session_as_it_was(spark, small):
    with settings(spark, {"spark.sql.session.timeZone": "Asia/Tokyo"}):
        df = queries()["casts_math"](spark, small)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert df.count() > 0
