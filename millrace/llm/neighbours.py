"""Nearest neighbours by inner product: inverted lists with an adaptive dimension scan.

Vectors are listed under their nearest centroid. A query probes lists, nearest centroid
first, until they hold a stated share of all rows. Within a list, vectors and queries are
rotated by a random orthogonal matrix, so that any m of d columns are a fair sample of the
product: d / m times the partial product estimates it, with a standard error that follows from
the lengths of the two vectors. After each column block a candidate is abandoned if the estimate
plus DEVIATIONS standard errors stays below the k-th best product so far, which happens to a true
neighbour once in about 700 tests at most. Survivors are scored exactly on the original vectors
in double precision.

Centroids and the share come from a sample of at most FIT_ROWS vectors: the smallest share
that, with the losses of the same tests, finds TARGET_RECALL of the sample queries' true
neighbours. Every row is indexed. Small lists are packed into chunks of about CHUNK_ROWS vectors
and large ones cut, queries into blocks of BLOCK_QUERIES, by their measured size; a query goes to
a chunk once, whatever number of its lists it probes. So a list that holds a third of all rows is
many tasks' work and no group is unbounded.

Vectors that are null, of zero length, or hold null or non-finite components take no part,
nor do vectors of another dimension than the most frequent one. Rows that repeat an id count
once (the smallest vector stays). Ties go to the smaller id. Queries with fewer candidates
than asked for get all of them. Rows without an id take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_batches
from millrace.workspace import materialize

FIT_ROWS = 10_000
FIT_QUERIES = 200
TARGET_RECALL = 0.95
#: Standard errors that a test allows.
DEVIATIONS = 3.0
#: Lists are half the square root of the rows, this many at most.
MOST_LISTS = 4_096
#: Part of a query's lists, the nearest, that set its bar for the others.
FIRST_PART = 0.1
COLUMN_BLOCK = 16
#: Share of pairs left from which they are followed one by one.
FEW = 0.3
CHUNK_ROWS, BLOCK_QUERIES = 2_048, 512
SEED = 42


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every run."""
    return np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))[0]


@dataclass
class Index:
    """Centroids, rows in each list (once known), and the share of rows a query probes."""

    centroids: np.ndarray
    share: float
    sizes: np.ndarray | None = None

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        return np.argmax(vectors @ self.centroids.T, axis=1)

    def probes(self, query: np.ndarray, least: int) -> np.ndarray:
        """Lists in order until they hold the share of all rows and ``least`` rows."""
        order = np.argsort(-(self.centroids @ query), kind="stable")
        held = np.cumsum(self.sizes[order])
        need = max(self.share * held[-1], min(least, held[-1]))
        return order[: int(np.searchsorted(held, need)) + 1]


def fit_centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Spherical k-means on unit vectors."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    centres = unit[np.random.default_rng(SEED).choice(len(unit), lists, replace=False)]
    for _ in range(8):
        own = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centres)
    return centres


def spread_of(lengths: np.ndarray, bars: np.ndarray) -> np.ndarray:
    """Standard error of an estimate from one column in many, of a product that just reaches its bar."""
    return np.sqrt(lengths**2 + np.minimum(bars, lengths) ** 2)


def cutoff(done: int, size: int, bars: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Partial product after ``done`` of ``size`` columns below which a candidate is abandoned: scaled up,
    it is DEVIATIONS standard errors under the bar."""
    return (bars - DEVIATIONS * np.sqrt(1 / done - 1 / size) * spread) * (done / size)


def fit_share(sample: np.ndarray, index: Index, k: int) -> float:
    """Share of rows to probe so that TARGET_RECALL of true neighbours lie in probed lists and
    survive the tests against the k-th best."""
    own = index.nearest(sample)
    sizes = np.bincount(own, minlength=len(index.centroids))
    turned = sample @ rotation(sample.shape[1])
    shares, lost = [], 0
    for at in range(0, len(sample), max(1, len(sample) // FIT_QUERIES)):
        products = sample @ sample[at]
        products[at] = -np.inf
        best = np.argsort(-products, kind="stable")[: min(k, len(sample) - 1)]
        order = np.argsort(-(index.centroids @ sample[at]), kind="stable")
        reach = np.empty(len(order))
        reach[order] = np.cumsum(sizes[order]) / len(sample)
        shares.extend(reach[own[best]])
        if len(best) == k:
            lost += int((~survive(turned[at : at + 1], turned[best], products[best[-1:]])[0]).sum())
    if not shares:
        return 1.0
    return float(np.quantile(shares, min(1.0, TARGET_RECALL / (1 - lost / len(shares)))))


def survive(q: np.ndarray, x: np.ndarray, bars: np.ndarray) -> np.ndarray:
    """Which rotated candidates pass all tests of each rotated query."""
    size, alive, partial = q.shape[1], np.ones((len(q), len(x)), bool), np.zeros((len(q), len(x)))
    lengths = np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1))
    bars = bars[:, None] - 1e-9 * (1 + lengths)
    spread = spread_of(lengths, bars)
    for last in range(COLUMN_BLOCK, size, COLUMN_BLOCK):
        block = slice(last - COLUMN_BLOCK, last)
        partial += q[:, block] @ x[:, block].T
        alive &= partial >= cutoff(last, size, bars, spread)
    return alive


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, v)`` with arrays of doubles, one row an id, without what takes no part."""
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        "id is not null and v is not null"
    )
    good = rows.where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    )
    single = materialize(good.groupBy("id").agg(F.min("v").alias("v")), "vectors")
    common = single.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return single.where(F.size("v") == (common["size"] if common else 0))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.array(flat, np.float64).reshape(len(column), -1)


def fit(vectors: DataFrame, rows: int, k: int) -> Index:
    """Centroids and share from at most FIT_ROWS vectors, chosen by a hash of their id."""
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("v").toArrow()
    points = matrix(sample["v"].combine_chunks())
    lists = max(1, min(MOST_LISTS, len(points) // 4, math.isqrt(rows) // 2))
    index = Index(fit_centroids(points, lists), 1.0)
    index.share = fit_share(points, index, k)
    return index


def best_of(
    queries: np.ndarray, query_ids: np.ndarray, found: np.ndarray, ids: np.ndarray, bars: np.ndarray, k: int,
    probed: np.ndarray | None = None, left: list | None = None,
):
    """For each query its up to k best of the candidates, as (query position, id, score).

    ``bars``: products that the k-th best of each query is known to reach. ``probed``: which
    candidates are in lists that a query probes. ``left`` takes the number of candidates before the
    first block and after each.
    """
    size = queries.shape[1]
    turn = rotation(size)
    q, x = queries @ turn, found @ turn
    lengths = np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1))
    # Rounding must neither abandon nor part ties, so all that are close to the bar are scored exactly.
    slack = 1e-9 * (1 + lengths.max(axis=1, initial=0))
    bars = bars - slack
    spread = spread_of(lengths, bars[:, None])
    alive = query_ids[:, None] != ids[None, :]
    if probed is not None:
        alive &= probed
    counts = [int(alive.sum())]
    partial, a, b = np.zeros(alive.shape), None, None
    for first in range(0, size, COLUMN_BLOCK):
        last = min(size, first + COLUMN_BLOCK)
        if a is None:
            partial += q[:, first:last] @ x[:, first:last].T
            if last < size:
                alive &= partial >= cutoff(last, size, bars[:, None], spread)
            if alive.mean() < FEW or last == size:
                # From here on only the pairs that are left.
                a, b = np.nonzero(alive)
                sums = partial[a, b]
        else:
            for part in range(0, len(a), 1 << 18):
                at = slice(part, part + (1 << 18))
                sums[at] += np.einsum("ij,ij->i", q[a[at], first:last], x[b[at], first:last])
            if last < size:
                left_over = sums >= cutoff(last, size, bars[a], spread[a, b])
                a, b, sums = a[left_over], b[left_over], sums[left_over]
        counts.append(int(alive.sum()) if a is None else len(a))
    if left is not None:
        left.append(counts)
    ends = np.searchsorted(a, np.arange(len(q) + 1))
    for query in range(len(q)):
        own, reached = b[ends[query] : ends[query + 1]], sums[ends[query] : ends[query + 1]]
        bar = bars[query]
        if len(own) > k:
            bar = max(bar, np.partition(reached, len(own) - k)[len(own) - k] - slack[query])
        own = own[reached >= bar]
        if len(own):
            scores = (queries[query] * found[own]).sum(axis=1)
            order = np.lexsort((ids[own], -scores))[:k]
            yield query, ids[own][order], scores[order]


SCAN = "query_id bigint, vec_id bigint, score double"


def scan_cells(cells: DataFrame, k: int) -> DataFrame:
    """Best candidates of each cell ``(chunk, block)`` for each of its queries. ``lists``: the own
    list of a candidate, or those of the chunk that a query probes."""

    def run(table: pa.Table) -> pa.Table:
        is_query = table["bar"].is_valid().to_numpy()
        vectors = matrix(table["v"].combine_chunks())
        ids, lists = table["id"].to_numpy(), table["lists"].to_pylist()
        out: tuple[list, list, list] = ([], [], [])
        if is_query.any() and not is_query.all():
            own = np.array([x[0] for x, asks in zip(lists, is_query) if not asks])
            probed = np.stack([np.isin(own, x) for x, asks in zip(lists, is_query) if asks])
            asked = ids[is_query]
            bars = table["bar"].to_numpy()[is_query]
            found = best_of(vectors[is_query], asked, vectors[~is_query], ids[~is_query], bars, k, probed)
            for query, near, scores in found:
                out[0].append(np.full(len(near), asked[query]))
                out[1].append(near)
                out[2].append(scores)
        columns = [np.concatenate(x) if x else np.empty(0) for x in out]
        return pa.table({
            "query_id": pa.array(columns[0].astype(np.int64)), "vec_id": pa.array(columns[1].astype(np.int64)),
            "score": pa.array(columns[2].astype(np.float64)),
        })

    return cells.groupBy("chunk", "block").applyInArrow(run, SCAN)


def own_lists(vectors: DataFrame, index: Index) -> DataFrame:
    """``(id, v, list)``: each vector and its list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = index.nearest(matrix(batch.column(1))) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists.astype(np.int32))], ["id", "v", "list"])

    return map_batches(vectors, run, "id bigint, v array<double>, list int")


def probed_chunks(vectors: DataFrame, index: Index, chunk_of: np.ndarray, least: int) -> DataFrame:
    """``(id, pack, lists, first)``: for each query the packs of lists it probes, with those lists;
    ``first`` marks the nearest. Vectors are left behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for key, point in zip(batch.column(0).to_pylist(), matrix(batch.column(1)) if batch.num_rows else ()):
                lists = index.probes(point, least)
                first = np.arange(len(lists)) < max(1, FIRST_PART * len(lists))
                for near in (True, False):
                    chosen = lists[first == near]
                    packs = chunk_of[chosen]
                    rows += [(key, int(pack), chosen[packs == pack].tolist(), near) for pack in np.unique(packs)]
            columns = list(zip(*rows)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds)], ["id", "pack", "lists", "first"]
            )

    return map_batches(vectors, run, "id bigint, pack int, lists array<int>, first boolean")


def packs_of(sizes: np.ndarray) -> np.ndarray:
    """Pack of each list: lists side by side until they hold CHUNK_ROWS vectors."""
    packs, pack, held = [], 0, 0
    for size in sizes:
        if held and held + size > CHUNK_ROWS:
            pack, held = pack + 1, 0
        packs.append(pack)
        held += int(size)
    return np.array(packs, np.int32)


def top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(df: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of each row where ``is_query`` holds.

    ``is_query`` gets the id as a column.
    """
    vectors = usable(df, key, vector).withColumn("id", F.col("id").cast("long"))
    rows = vectors.count()
    if not rows:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = fit(vectors, rows, k)
    listed = materialize(own_lists(vectors, index), "lists")
    sizes = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}
    index.sizes = np.array([sizes.get(i, 0) for i in range(len(index.centroids))])
    pack_of = packs_of(index.sizes)
    asking = vectors.where(is_query(F.col("id")))
    asked = materialize(probed_chunks(asking, index, pack_of, k + 1), "asked")
    grid = {r["pack"]: r["queries"] for r in asked.groupBy("pack").agg(F.count_distinct("id").alias("queries")).collect()}
    held = np.bincount(pack_of, index.sizes, minlength=int(pack_of[-1]) + 1).astype(int)
    # One row a list, MOST_LISTS at most.
    table = F.broadcast(df.sparkSession.createDataFrame(
        [(i, int(pack)) for i, pack in enumerate(pack_of)], "list int, pack int"
    ))
    packs = F.broadcast(df.sparkSession.createDataFrame(
        [(i, -(-int(n) // CHUNK_ROWS), -(-grid.get(i, 0) // BLOCK_QUERIES)) for i, n in enumerate(held)],
        "pack int, chunks int, blocks int",
    ))

    def salt(count: str):
        return F.pmod(F.xxhash64("id"), F.col(count)).cast("int")

    def cells(queries: DataFrame, bars: DataFrame | None) -> DataFrame:
        """Each candidate beside each block of queries, each query beside each chunk of its packs."""
        both = ["id", "v", "bar", "lists", F.struct("pack", "part").alias("chunk"), "block"]
        candidates = (
            listed.join(table, "list").join(packs, "pack").where("blocks > 0").withColumn("part", salt("chunks"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("bar", F.lit(None).cast("double")).withColumn("lists", F.array("list")).select(both)
        )
        queries = queries.join(packs, "pack").where("chunks > 0").withColumn("block", salt("blocks"))
        if bars is None:
            queries = queries.withColumn("bar", F.lit(float("-inf")))
        else:
            queries = queries.join(bars, "id", "left").withColumn("bar", F.coalesce("bar", F.lit(float("-inf"))))
        queries = queries.join(asking, "id").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        return candidates.union(queries.select(both))

    # The nearest lists of each query set the bar for all others.
    first = materialize(scan_cells(cells(asked.where("first"), None), k), "first")
    bars = top(first, k).groupBy(F.col("query_id").alias("id")).agg(F.min("score").alias("bar"), F.count("*").alias("n"))
    bars = bars.where(F.col("n") == k).drop("n")
    others = scan_cells(cells(asked.where("not first"), bars), k)
    return top(first.union(others), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
