"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum and a join, so no adjacency list is ever gathered; the
edges are checkpointed each round.  Before the first round every partition replaces its
edges by a spanning star of what it sees, which ends most inputs in two or three rounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

MAX_ROUNDS = 40


def _forest(batches):
    """Spanning stars (root, node) of the edges of one partition, root the smallest node."""
    seen = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
    if seen:
        a, b = (np.concatenate(x) for x in zip(*seen))
        nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
        i, j = at[: len(a)], at[len(a) :]
        root = np.arange(len(nodes))
        while True:
            low = np.minimum(root[i], root[j])
            new = root.copy()
            np.minimum.at(new, root[i], low)
            np.minimum.at(new, root[j], low)
            new = new[new]
            if np.array_equal(new, root):
                break
            root = new
        away = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[root[away]]), pa.array(nodes[away])], names=["a", "b"])


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)`` that is not its component's smallest.

    Self-loops and repeated edges do no harm; no edges give no rows.
    """
    now = C.cut(edges.where("a <> b").mapInArrow(C.tidy(_forest), "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    for _ in range(MAX_ROUNDS):
        if _settled(now):
            break
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b")
        large = C.cut(large.distinct())
        # small star: from each node to its smaller neighbours
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        linked = large.join(low, "b")
        now = C.cut(linked.select(F.col("m").alias("a"), "b").union(linked.select(F.col("m").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component"))


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: no node has two roots, and no root has one."""
    ends = edges.select(F.col("b").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(edges.select("a", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("child").alias("c"), F.max("root").alias("r")).where("c > 1 or (c > 0 and r > 0)").isEmpty()
