"""Clusters against a plain Lloyd in Python integers."""

from __future__ import annotations

import hashlib
import math
import random

import pytest

from millrace.llm import centroids
from millrace.llm.queries import QUERIES


def slow(vectors, dimensions=64, clusters=16, rounds=3):
    """Rows of the report for ``(vec_id, vector)`` pairs."""
    kept = [
        (key, [math.floor(64 * x) for x in vector])
        for key, vector in vectors
        if vector is not None and len(vector) == dimensions and all(x is not None and math.isfinite(x) for x in vector)
    ]
    mark = lambda row: (row[0] is None, hashlib.sha256(f"1:{row[0]}".encode()).hexdigest(), row[1])
    centres = [list(parts) for _, parts in sorted(kept, key=mark)[:clusters]]

    def nearest(parts):
        return min((sum((a - b) ** 2 for a, b in zip(parts, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, parts in kept:
            groups.setdefault(nearest(parts)[1], []).append(parts)
        for k, members in groups.items():
            centres[k] = [sum(column) // len(members) for column in zip(*members)]
    found = [(key, *nearest(parts)) for key, parts in kept]
    rows = []
    for key, distance, k in found:
        inertia = sum(d for _, d, c in found if c == k)
        digest = hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest()
        rows.append((key, k, distance, inertia, sum(d for _, d, _ in found), digest))
    return sorted(rows, key=repr)


def test_query_on_whole_table(spark, small):
    vectors = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, QUERIES["op11_centroids"](spark, small).collect()), key=repr) == slow(vectors)


@pytest.mark.parametrize("block_columns", [1, 3, 4, 100])
def test_blocks_of_any_width_agree(spark, block_columns):
    rng = random.Random(5)
    vectors = [(i, [rng.choice([-1.0, 0.0, 0.4, 2.5]) for _ in range(5)]) for i in range(80)]
    vectors += [(7, vectors[7][1])] * 40 + [(i, vectors[3][1]) for i in range(200, 260)]  # repeated rows, a hot vector
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    as_float = [(key, [float(x) if x != 0.4 else 0.4000000059604645 for x in v]) for key, v in vectors]
    got = centroids.report(df, dimensions=5, clusters=6, block_columns=block_columns)
    assert sorted(map(tuple, got.collect()), key=repr) == slow(as_float, 5, 6)


def test_odd_vectors(spark):
    rows = [
        (1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [math.nan, 1.0]), (6, [math.inf, 0.0]),
        (None, [0.5, 0.25]), (8, [-0.01, 3.0]), (8, [-0.01, 3.0]), (9, [1e300, 0.0]), (10, [1.0, 2.0, 3.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as row", "2 as cluster", "3 as parts")
    got = {(r["vec_id"], r["cluster"], r["distance"]) for r in centroids.report(df, dimensions=2).collect()}
    # Fewer vectors than clusters: each is its own centroid; of equal ones the smaller number counts.
    assert {key for key, _, _ in got} == {None, 8, 9} and all(distance == 0 for _, _, distance in got)
    assert centroids.report(df, dimensions=2).count() == 4
    assert centroids.report(df.limit(0), dimensions=2).count() == 0
    assert centroids.report(df, dimensions=7).columns[0] == "vec_id"
