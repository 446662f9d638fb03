"""Phrases and templates against brute force, and the query against its SQL."""

from __future__ import annotations

import math
import textwrap

from compare import mismatch
from llm_words import words
from millrace.llm import licenses
from millrace.llm.queries import ORACLES, QUERIES


def slow(docs):
    out = []
    for key, text in docs:
        own = words(text)
        at = {label: [] for label in licenses.PHRASES.values()}
        for phrase, label in licenses.PHRASES.items():
            parts = phrase.split()
            at[label] += [i for i in range(len(own)) if own[i : i + len(parts)] == parts]
        starts = sorted(x for places in at.values() for x in places)
        base = {label for label, places in at.items() if places}
        labels, best = set(base), 0.0
        for label, notice in licenses.TEMPLATES:
            wanted, width = set(licenses.template_words(notice)), licenses.block_words(notice)
            for i in range(len(own)):
                common = len(wanted & set(own[i : i + width]))
                if common >= math.ceil(licenses.CONTAINMENT * len(wanted) - 1e-9):
                    labels.add(label)
                    best = max(best, common / len(wanted))
        out.append((
            key, len(own), len(starts), starts[0] if starts else None, starts[-1] if starts else None,
            ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if starts else best,
        ))
    return sorted(out, key=repr)


WRAPPED = textwrap.fill("foo " * 30 + licenses.TEMPLATES[1][1] + " bar " * 20 + licenses.TEMPLATES[6][1], 30)
SCATTERED = " ".join(word + " filler" * 60 for word in "licensed under cc by nc 4 0".split())


def test_wrapped_notices_and_scattered_words(spark):
    comment = "\n".join(f" * {line}" for line in WRAPPED.split("\n"))
    rows = [(1, WRAPPED), (2, comment), (3, SCATTERED), (4, WRAPPED.replace("\n", " ")), (5, "x " * 30_000 + WRAPPED)]
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: ("bsd,mit", 1.0), 2: ("bsd,mit", 1.0), 3: ("", 0.0), 4: ("bsd,mit", 1.0), 5: ("bsd,mit", 1.0)}


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "MIT License"), (3, "MIT License"), (4, "mit mit license\nLicensed under cc by nc 4"),
            (None, "\n\nreleased UNDER the, mit license\nx"), (5, "gpl " * 20_000 + "GENERAL public-license"),
            (8, WRAPPED), (9, SCATTERED), (10, " ".join(reversed(licenses.TEMPLATES[5][1].split()))),
            (6, " ".join(n for _, n in licenses.TEMPLATES)), (7, "\n".join(n for _, n in licenses.TEMPLATES))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as label", "2 as rank", "3 as n_words")
    assert sorted(map(tuple, licenses.scan(docs).collect()), key=repr) == slow(rows)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_query_agrees_with_sql_and_brute_force(spark, small, duck):
    df = QUERIES["op10_licenses"](spark, small)
    assert mismatch(df, duck.sql(ORACLES["op10_licenses"])) is None
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, df.collect()), key=repr) == slow(docs)
