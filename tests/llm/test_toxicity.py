"""Ordinal regression: held-out recall, gradients, and odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from millrace.llm import toxicity
from millrace.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(spark.read.parquet(f"{MEDIUM}/documents.parquet"), spark.read.parquet(f"{MEDIUM}/labels.parquet"))


def test_held_out_documents(spark, model):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = [
        r for r in toxicity.score(docs, model).collect()
        if r["doc_id"] in labels and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
    ]
    toxic = [r["toxic"] for r in rows if labels[r["doc_id"]] == 1]
    clean = [r["toxic"] for r in rows if labels[r["doc_id"]] == 0]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.01
    assert all(0 <= r["severity"] <= toxicity.GRADES and r["severity"] >= r["p_toxic"] - 1e-12 for r in rows)


def test_ordered_data_is_learned():
    rng = np.random.default_rng(5)
    grades = rng.integers(0, 4, 600)
    rows, columns = np.nonzero(rng.random((600, 6)) < (0.1 + 0.25 * grades[:, None] * (np.arange(6) < 3)))
    weights, cuts = toxicity.fit_thresholds(rows, columns, grades, 6)
    assert np.all(np.diff(cuts) > 0) and weights[:3].min() > 2 * np.abs(weights[3:]).max()


def test_odd_rows(spark, model):
    rows = [(1, None, "a"), (2, "", "b"), (3, "You STUPID worthless scum!!", "c"), (3, "You STUPID worthless scum!!", "c"),
            (None, "fine words", "d"), (4, "fine " * 50_000, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    judged = sorted(((r["doc_id"], r["toxic"]) for r in toxicity.score(docs, model).collect()), key=repr)
    assert judged == sorted([(1, False), (2, False), (3, True), (3, True), (None, False), (4, False)], key=repr)
    kept = toxicity.keep_clean(docs, model)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([r for r in rows if r[0] != 3], key=repr)
    assert toxicity.keep_clean(docs.limit(0), model).count() == 0


def test_without_both_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "scum"), (3, "x")], "doc_id long, text string")
    for known in ([], [(1, 1)], [(1, None), (3, 0)]):
        labels = spark.createDataFrame(known, "doc_id long, toxic int")
        none = toxicity.fit(docs, labels)
        assert none.thresholds == [] and not any(r["toxic"] for r in toxicity.score(docs, none).collect())


def test_query_covers_the_table(spark, small):
    rows = QUERIES["op4_toxicity"](spark, small).collect()
    assert len(rows) == spark.read.parquet(f"{small}/documents.parquet").count()


def loss(parameters, rows, columns, grades, size):
    """Penalised loss of weights and thresholds, as the definition has it."""
    weights, cuts = parameters[:size], parameters[size:]
    total = np.bincount(rows, weights[columns], len(grades))
    below = 1 / (1 + np.exp(total[:, None] - cuts))
    full = np.concatenate([np.zeros((len(grades), 1)), below, np.ones((len(grades), 1))], axis=1)
    at = np.arange(len(grades))
    chance = np.maximum(full[at, grades + 1] - full[at, grades], 1e-12)
    return -np.log(chance).mean() + toxicity.L2 / 2 * (weights**2).sum()


def test_fit_against_a_slow_descent():
    """Numeric gradients and small steps that only go down end where the fit does."""
    rng = np.random.default_rng(11)
    grades = rng.integers(0, 4, 400)
    rows, columns = np.nonzero(rng.random((400, 5)) < (0.1 + 0.2 * grades[:, None] * (np.arange(5) < 2)))
    weights, cuts = toxicity.fit_thresholds(rows, columns, grades, 5)
    given = (rows, columns, grades, 5)
    at, step = np.concatenate([np.zeros(5), [-1.0, 0.0, 1.0]]), 1.0
    for _ in range(600):
        gradient = np.array([(loss(at + e, *given) - loss(at - e, *given)) / 2e-5 for e in 1e-5 * np.eye(8)])
        while step > 1e-9 and loss(at - step * gradient, *given) > loss(at, *given):
            step /= 2
        at, step = at - step * gradient, step * 1.5
    assert loss(np.concatenate([weights, cuts]), *given) <= loss(at, *given) + 1e-3
    assert np.allclose(weights, at[:5], atol=0.1) and np.allclose(cuts, at[5:], atol=0.1)


def test_a_tie_counts_as_toxic():
    model = toxicity.OrdinalModel({"bad": 2.0, "worse": 1.0}, [2.0, 4.0])
    assert model.judge("bad")[::2] == (0.5, True)
    assert model.judge("worse")[2] is False and model.judge(None)[2] is False
    assert model.judge("bad worse")[1] > model.judge("bad")[1]


def test_severity_follows_the_insults(spark, model):
    """Texts with more insults are graded higher."""
    texts = [(1, "fine " * 40), (2, "stupid " + "fine " * 40), (3, "stupid worthless scum idiot moron pathetic garbage loser")]
    made = spark.createDataFrame(texts, "doc_id long, text string")
    severity = {r["doc_id"]: r["severity"] for r in toxicity.score(made, model).collect()}
    assert severity[1] < severity[2] <= severity[3]


def test_long_texts_with_few_insults_are_caught(spark):
    """Grades rise with the insults while lengths fall; the label must not suffer from that."""
    rng = np.random.default_rng(23)
    insults, filler = [f"insult{c}" for c in "abcdefghijkl"], [f"word{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    texts, marks = [], []
    for i in range(1200):
        toxic = i % 3 == 0
        bad = 1 + i // 3 % 6 if toxic else 0
        length = 360 - 58 * bad if toxic else int(rng.integers(10, 360))
        words = [*rng.choice(insults, bad, replace=False), *rng.choice(filler, length)]
        texts.append((i, " ".join(rng.permutation(words))))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    fitted = toxicity.fit(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    said = {r["doc_id"]: r["toxic"] for r in toxicity.score(docs, fitted).collect()}
    assert np.mean([said[i] for i, toxic in marks if toxic]) > 0.95
    assert np.mean([said[i] for i, toxic in marks if not toxic]) < 0.01
