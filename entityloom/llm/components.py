"""Connected components of a graph given as edges of two longs, by alternating stars.

Edges lead from their larger to their smaller end. The large-star step ties
every larger neighbour of a node to the node's smallest neighbour, the
small-star step ties its smaller neighbours and itself to the smallest; both
keep the components. They repeat until nothing changes, which takes a number of
rounds about logarithmic in the longest path. Both steps only ask for a node's
smallest smaller neighbour: one grouping with partial aggregation, stored. It is
joined to the edges, stored too, so nothing groups on either side of the join
and adaptive execution splits the rows of a node that holds much of the graph.
No component is ever gathered. A round's tables are deleted after the next.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import drop_stored, stored


def _smallest(edges: DataFrame) -> DataFrame:
    """``node, least`` of every node with a smaller neighbour."""
    return stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")))


def _large_star(edges: DataFrame, smallest: DataFrame) -> DataFrame:
    """The larger end of each edge tied to the smallest neighbour of the smaller end, or to it where it has none."""
    tied = edges.join(smallest, F.col("b") == F.col("node"), "left")
    return tied.select("a", F.coalesce("least", "b").alias("b")).distinct()


def _small_star(edges: DataFrame, smallest: DataFrame) -> DataFrame:
    """The smaller neighbours of each node, and the node, tied to the smallest of them."""
    tied = edges.join(smallest, F.col("a") == F.col("node")).filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.union(smallest.select(F.col("node").alias("a"), F.col("least").alias("b"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    """Two equal tables have equal signatures; counts and hash sums of all rows."""
    h = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (a, b): the smallest node that is reachable.

    Edges from a node to itself and repeated edges change nothing; edges with
    a missing end are left out. No edges give no rows.
    """
    clean = edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).filter("a <> b")
    now = stored(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, after = None, _signature(now)
    while after[0] and before != after:
        smallest = _smallest(now)
        large = stored(_large_star(now, smallest))
        drop_stored(now, smallest)
        smallest = _smallest(large)
        now = stored(_small_star(large, smallest))
        drop_stored(large, smallest)
        before, after = after, _signature(now)
    # every remaining edge ties a node to its root
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def join_trees(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inside a task: roots of numbered nodes after joining the trees of all a and b."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
