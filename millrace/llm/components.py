"""Connected components of a graph given by its edges."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.workspace import materialize


def components(edges: DataFrame) -> DataFrame:
    """One row ``(node, root)`` for each node of ``edges(a, b)``; nodes of a component share a root.

    Each round moves every node to the neighbour (or itself) that comes first in an order
    drawn anew for the round, and joins nodes that moved to the same place. A random order
    makes the graph shrink by a constant share a round, chains too, where an order by id
    would take a step at a time. Every round is written to the shared folder, so a lost
    executor never repeats earlier rounds. No edges give no rows.
    """
    edges = materialize(edges.where("a != b").select("a", "b").distinct(), "edges")
    roots = None
    for number in count():
        if roots is not None and edges.isEmpty():
            return roots

        def placed(node: str):
            return F.struct(F.xxhash64(F.lit(number), node).alias("place"), F.col(node).alias("node"))

        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = materialize(
            both.groupBy("a").agg(F.min(placed("b")).alias("first"))
            .select(F.col("a").alias("from"), F.least(placed("a"), F.col("first"))["node"].alias("to")),
            "moves",
        )
        if roots is None:
            roots = moves.select(F.col("from").alias("node"), F.col("to").alias("root"))
        else:
            moved = roots.join(moves, F.col("root") == F.col("from"), "left")
            roots = materialize(
                moved.select("node", F.coalesce("to", "root").alias("root")), "roots"
            )
        to_a = moves.select(F.col("from").alias("a"), F.col("to").alias("to_a"))
        to_b = moves.select(F.col("from").alias("b"), F.col("to").alias("to_b"))
        edges = materialize(
            edges.join(to_a, "a").join(to_b, "b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .where("a != b").distinct(),
            "edges",
        )
