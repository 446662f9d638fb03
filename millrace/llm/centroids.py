"""Centroid clustering by dimension-sharded Lloyd rounds over whole-number vectors.

The columns of the vectors are cut into blocks, and each block is a table of its own. A round
has two steps. Tasks of a column block compare their part of each vector with the same part of
every centroid; the partial squared distances are added by row (partial sums first, then one
shuffle of a row number and one number a centroid), and the least sum names the cluster. Then
each block adds up its own columns by cluster and replaces its own part of the centroids. Tasks
of a round never hold whole vectors or centroids, so wide vectors only mean more blocks.

Everything is exact: components are integers, distances are sums of squares, and a new centroid
component is the floor of an exact quotient. Ties go to the smaller cluster number; a cluster
that no vector is nearest to keeps its centroid.

What reaches the driver is the centroids: clusters times dimensions numbers, whatever the rows.
Block tables are written to the shared folder once; a round reads them and hands on nothing but
centroids, so a lost executor costs tasks of the running round only.

Vectors that are null, have another number of components, or hold a null or non-finite one are
left out. Repeated rows and ids are rows of their own. Null ids are kept and come last among
the seeds. Fewer vectors than clusters make fewer clusters; no vector gives no row. Components
are limited to +-2^27 after scaling, since the squared distance must fit a long; sums that do
not fit give null. Only the key and the vector are read, so other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches
from millrace.workspace import materialize

DIMENSIONS = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
#: Vectors are multiplied by this before they are cut to integers.
SCALE = 64
#: Columns of a block.
BLOCK_COLUMNS = 32
#: Largest component: 64 squares of twice this fit a long.
LARGEST = 1 << 27


def whole_vectors(vectors: DataFrame, key: str, vector: str, dimensions: int, scale: int) -> DataFrame:
    """``(row, key, parts)``: numbered rows with integer components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Beyond the limit the product may not fit a long, so it is limited as a double.
    limited = lambda x: F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))
    kept = vectors.where((F.size(vector) == dimensions) & finite)
    return kept.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.transform(vector, lambda x: F.floor(limited(x)).cast("long")).alias("parts"),
    )


def seeds(rows: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors whose key has the smallest hash; a top-k of ``clusters`` rows."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    chosen = rows.select(mark.alias("mark"), "parts").orderBy(F.asc_nulls_last("mark"), "parts").limit(clusters)
    return [list(row["parts"]) for row in chosen.collect()]


class Block:
    """One column block: its stored table ``(row, part)`` and its part of the centroids."""

    def __init__(self, rows: DataFrame, number: int, first: int, last: int, centroids: np.ndarray):
        part = F.slice("parts", first + 1, last - first).alias("part")
        self.table = materialize(rows.select("row", part), f"block-{number}")
        self.width = last - first
        self.slices = centroids[:, first:last]

    def distances(self) -> DataFrame:
        """``row`` and the block's share of the squared distance to each centroid."""
        slices, width = self.slices, self.width
        names = ["row", *(f"d{k}" for k in range(len(slices)))]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts = matrix(batch.column(1), width)
                columns = [pa.array(((parts - centre) ** 2).sum(axis=1)) for centre in slices]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

        return map_batches(self.table, run, ", ".join(f"{name} bigint" for name in names))

    def sums(self, assigned: DataFrame) -> DataFrame:
        """``(cluster, column, total)`` over the rows of each cluster; at most one row for each
        cluster and column leaves a task."""
        width, clusters = self.width, len(self.slices)
        names = ["cluster", "column", "total"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((clusters, width), np.int64)
            for batch in batches:
                parts, labels = matrix(batch.column(0), width), batch.column(1).to_numpy(zero_copy_only=False)
                for number in range(clusters):
                    total[number] += parts[labels == number].sum(axis=0)
            at = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(x.ravel()) for x in (*at, total)], names)

        joined = self.table.join(assigned, "row").select("part", "cluster")
        return map_batches(joined, run, "cluster bigint, column bigint, total bigint")

    def update(self, assigned: DataFrame, sizes: dict[int, int]) -> None:
        """Replace the block's part of every non-empty centroid by the floor of the mean."""
        totals = self.sums(assigned).groupBy("cluster", "column").agg(
            F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
        )
        slices = self.slices.copy()
        for cluster, column, total in totals.collect():
            if sizes.get(cluster):
                slices[cluster, column] = int(total) // sizes[cluster]
        self.slices = slices


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Equal lists of integers as the rows of a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def assignments(blocks: Sequence[Block]) -> DataFrame:
    """``(row, cluster, distance)``: partial distances added by row, then the least of them."""
    partial = reduce(DataFrame.unionAll, [block.distances() for block in blocks])
    names = [name for name in partial.columns if name != "row"]
    added = partial.groupBy("row").agg(*[F.sum(name).alias(name) for name in names])
    least = F.least(*names) if len(names) > 1 else F.col(names[0])
    cluster: Column = F.coalesce(*[F.when(F.col(name) == least, F.lit(k)) for k, name in enumerate(names)])
    return added.select("row", cluster.cast("long").alias("cluster"), least.alias("distance"))


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    dimensions: int = DIMENSIONS,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    scale: int = SCALE,
    block_columns: int = BLOCK_COLUMNS,
) -> tuple[DataFrame, list[list[int]]]:
    """``(key, cluster, distance)`` of each kept vector, and the final centroids."""
    kept = materialize(whole_vectors(vectors, key, vector, dimensions, scale), "vectors")
    start = seeds(kept, clusters, seed)
    if not start:
        return kept.select(F.col("key").alias(key), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    cuts = [*range(0, dimensions, block_columns), dimensions]
    blocks = [
        Block(kept, i, first, last, np.array(start, np.int64)) for i, (first, last) in enumerate(zip(cuts, cuts[1:]))
    ]
    for _ in range(rounds):
        # Stored, since every block reads it: the distances are computed once.
        assigned = materialize(assignments(blocks).select("row", "cluster"), "assigned")
        sizes = {row["cluster"]: row["count"] for row in assigned.groupBy("cluster").count().collect()}
        for block in blocks:
            block.update(assigned, sizes)
    last = assignments(blocks).join(kept.select("row", "key"), "row")
    centroids = np.concatenate([block.slices for block in blocks], axis=1).tolist()
    return last.select(F.col("key").alias(key), F.col("cluster").cast("int").alias("cluster"), "distance"), centroids


def centroid_hash(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def report(vectors: DataFrame, key: str = "vec_id", **parameters) -> DataFrame:
    """Each vector's cluster and distance with the inertia of its cluster and of all, and a hash
    of its centroid."""
    found, centroids = cluster(vectors, key, **parameters)
    found = materialize(found, "clusters")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {row["cluster"]: int(row["sum"]) for row in found.groupBy("cluster").agg(total.alias("sum")).collect()}
    as_long = lambda x: x if x < 1 << 63 else None
    facts = found.sparkSession.createDataFrame(  # one row a cluster
        [
            (i, as_long(inertia.get(i, 0)), as_long(sum(inertia.values())), centroid_hash(c))
            for i, c in enumerate(centroids)
        ],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return found.join(F.broadcast(facts), "cluster").select(
        key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
