"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import ship, written

ship(__name__)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each node's component, for nodes 0 to n - 1 and
    edges a-b: roots hook onto smaller roots, then paths are halved."""
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != (up := root[root])).any():
            root = up
    return root


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component, for every node in an
    edge. ``edges`` has long columns a and b.

    Each round hooks every root onto its smallest neighbouring root, follows
    the hooks to their ends by doubling, and contracts the edges, so it at
    least halves the roots that still have edges. All of it is joins and
    aggregates over written tables: a node with very many edges is
    pre-aggregated on one side and a split join on the other.
    """
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .where("a <> b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = nodes.withColumn("root", F.col("node"))
    while edges.limit(1).count():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = written(both.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("up"))
                        .select("x", F.least("x", "up").alias("up")), "hooks")
        while True:
            further = hooks.select(F.col("x").alias("up"), F.col("up").alias("further"))
            longer = written(hooks.join(further, "up").select("x", F.col("further").alias("up"),
                                                              (F.col("further") < F.col("up")).alias("moved")), "hooks")
            hooks = longer.select("x", "up")
            if not longer.where("moved").limit(1).count():
                break
        labels = written(labels.join(hooks, labels["root"] == hooks["x"], "left")
                         .select("node", F.coalesce("up", "root").alias("root")), "labels")
        ends = hooks.select(F.col("x").alias("b"), F.col("up").alias("to_b"))
        edges = written(edges.join(hooks.select(F.col("x").alias("a"), F.col("up").alias("to_a")), "a")
                        .join(ends, "b").where("to_a <> to_b")
                        .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
                        .distinct(), "edges")
    return labels
