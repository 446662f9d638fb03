"""Discriminant against numpy, held-out accuracy, and odd texts."""

from __future__ import annotations

import zlib

import numpy as np

from millrace.llm import quality
from millrace.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = QUERIES["op3_quality"](spark, MEDIUM).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    right = []
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.7)
        if row["held_out"] and row["doc_id"] in labels:
            right.append(row["predicted"] == labels[row["doc_id"]])
    assert len(right) > 50 and sum(right) / len(right) > 0.95


def test_scores_are_log_density_differences(spark):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(0, 1, (80, 3)), rng.normal(1, 2, (120, 3)) @ np.diag([1, 2, 0.5])])
    label = [0] * 80 + [1] * 120
    known = spark.createDataFrame([(y, *map(float, x)) for y, x in zip(label, points)], "label int, s0 double, s1 double, s2 double")
    model = quality.fit(known)
    densities, pooled = [], 0
    parts = [points[:80], points[80:]]
    for x in parts:
        pooled = pooled + np.cov(x.T, bias=True) * len(x) / 200
    for x in parts:
        mixed = 0.9 * np.cov(x.T, bias=True) + 0.1 * pooled
        mixed = 0.95 * mixed + 0.05 * np.diag(np.diag(mixed)) + quality.FLOOR * np.eye(3)
        away = points - x.mean(axis=0)
        far = np.einsum("ij,jk,ik->i", away, np.linalg.inv(mixed), away)
        densities.append(np.log(len(x) / 200) - 0.5 * np.linalg.slogdet(mixed)[1] - 0.5 * far)
    want = 1 / (1 + np.exp(densities[0] - densities[1]))
    got = [r[0] for r in known.select(model.score([known[c] for c in ("s0", "s1", "s2")])).collect()]
    assert np.allclose(got, want, atol=1e-9)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, "word " * 50_000)], "doc_id long, text string"
    ).selectExpr("*", "1 as score", "2 as s0", "3 as n", "4 as p")
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 0)], "doc_id long, quality int")
    for known, share in ((labels, 1.0), (labels.limit(0), 0.5)):
        rows = quality.score(docs, known).collect()
        assert len(rows) == 6 and {r["score"] for r in rows} == {share}
    assert quality.score(docs.limit(0), labels).count() == 0
