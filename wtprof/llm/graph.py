"""Connected components of a large edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wtprof.llm.common import written


class LocalUnion:
    """Components of up to n nodes within one task, from pairs in blocks.

    ``label`` is the least node of each node's component so far. Pairs that
    are already together cost a comparison; the others hook the larger label
    onto the smallest one seen, and labels are shortened until they rest."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            up = np.arange(len(self.label))
            np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
            while (up[up] != up).any():
                up = up[up]
            self.label = up[self.label]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(node, label) of every node that is not its own label."""
        node = np.flatnonzero(self.label != np.arange(len(self.label)))
        return node, self.label[node]


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    near = _neighbours(edges)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node
    of its component.

    ``edges`` has two integer columns a and b; direction, repeats and loops
    don't matter. Alternating large-star and small-star steps; each round's
    edges are written to the shared folder, so nothing but two numbers comes
    to the driver and a lost executor costs a re-read. Minima are
    pre-aggregated before their shuffle, and the joins on a hub's key are
    left to AQE to split.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  "edges")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
