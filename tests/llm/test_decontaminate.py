"""Hit words against brute force, and the query against its SQL."""

from __future__ import annotations

import hashlib
import re

import pytest

from compare import mismatch
from llm_words import words
from millrace.llm import decontaminate
from millrace.llm.queries import ORACLES, QUERIES

def slow(docs, items):
    found = {}
    for item, text in items:
        own = words(text)
        n = min(13, len(own))
        for at in range(len(own) - n + 1 if own else 0):
            found.setdefault(tuple(own[at : at + n]), set()).add(item)
    sizes = {len(w) for w in found}
    out = []
    for key, text in docs:
        own, hit, ids = words(text), set(), set()
        for n in sizes:
            for at in range(len(own) - n + 1):
                there = found.get(tuple(own[at : at + n]))
                if there:
                    hit.update(range(at, at + n))
                    ids |= there
        ids.discard(None)
        digest = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        out.append((key, len(own), len(hit), len(ids), digest, len(hit) > 0 and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


LETTERS = " ".join("abcdefghijklmnopqrstuvwxyz")
DOCS = [(1, None), (2, ""), (3, "A b c"), (3, "A b c"), (3, "x a b c a b c"), (None, "a b"), (5, "the The THE the"),
        (6, LETTERS), (7, f"z {LETTERS} {LETTERS[:40]}"), (8, "word " * 5_000 + LETTERS), (9, "É x")]
ITEMS = [(1, None), (2, ""), (3, "the"), (4, "a b c"), (5, "A, B! c"), (6, LETTERS[:31]), (None, "x a"), (3, "the"), (10, "é")]


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
@pytest.mark.parametrize("docs,items", [(DOCS, ITEMS), (DOCS, []), ([], ITEMS)])
def test_small_tables(spark, docs, items, broadcast_bytes):
    left = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as words", "2 as n", "3 as window")
    right = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as item", "2 as hash")
    found = decontaminate.contamination(left, right, broadcast_bytes=broadcast_bytes)
    got = [
        (r["doc"], r["n_words"], r["n_hit"], len(r["items"]),
         hashlib.sha256(",".join(sorted(map(str, r["items"]))).encode()).hexdigest(), r["contaminated"])
        for r in found.collect()
    ]
    assert sorted(got, key=repr) == slow(docs, items)


def test_contaminated_rows_go(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "'x' as doc", "1 as text_hash")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.without_contaminated(docs, items)
    assert kept.columns == docs.columns
    want = [k for (k, t) in DOCS if not slow([(k, t)], ITEMS)[0][5]]
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_query_agrees_with_sql_and_brute_force(spark, small, duck):
    df = QUERIES["op8_decontamination"](spark, small)
    assert mismatch(df, duck.sql(ORACLES["op8_decontamination"])) is None
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, df.select(columns).collect()), key=repr) == slow(docs, items)


def test_no_python_in_the_plan(spark, small):
    plan = QUERIES["op8_decontamination"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
