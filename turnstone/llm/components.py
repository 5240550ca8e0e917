"""Connected components of an edge list, by contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.session import materialize


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row of each row's component under the links (i, j)."""
    up = np.arange(n)
    while len(i):
        low = np.minimum(up[i], up[j])
        np.minimum.at(up, up[i], low)
        np.minimum.at(up, up[j], low)
        while (up[up] != up).any():
            up = up[up]
        live = up[i] != up[j]
        i, j = i[live], j[live]
    return up


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node and component (its smallest node) of every node in edges (a, b).

    Each round every node hooks to its smallest neighbour, chains are shortened once, and edges are rewritten to
    the nodes they now hang from; edges inside a tree vanish. Stars vanish in one round, and the number of edges
    falls fast with any shape. Minima are aggregated partially and joins are on unique keys, so a node with very
    many edges is split over tasks. Every round's tables are written to the shared folder.
    """

    def oriented(rows: DataFrame) -> DataFrame:
        return rows.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    rest = materialize(oriented(edges), name)
    labels = None
    while True:
        both = rest.union(rest.select("b", "a"))
        hooks = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up")), name)
        upper = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
        shorter = materialize(hooks.join(upper, "up").select("node", F.col("top").alias("up")), name)
        if labels is None:
            labels = shorter.select("node", F.col("up").alias("component"))
        else:
            moved = shorter.select(F.col("node").alias("component"), "up")
            labels = labels.join(moved, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        labels = materialize(labels, name)
        ends = lambda c: shorter.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up"))
        lifted = rest.join(ends("a"), "a").join(ends("b"), "b").select(F.col("a_up").alias("a"), F.col("b_up").alias("b"))
        chains = shorter.select("up").distinct().join(upper, "up").select(F.col("up").alias("a"), F.col("top").alias("b"))
        rest = materialize(oriented(lifted.union(chains)), name)
        if rest.isEmpty():
            return labels
