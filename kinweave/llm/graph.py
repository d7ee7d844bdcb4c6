"""Connected components of edge tables that no machine has to hold."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _util


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that join the same nodes as the edges (u, v), fewer
    than there are nodes. The root is a component's smallest node."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (two columns of one ordered
    type, any names); ``component`` is the smallest node reachable.

    Alternating large-star and small-star: each round links every node's
    neighbours to the smallest one. Rounds end when the edges no longer change,
    after about log(n) of them. Every round is written to the shared folder, so
    a lost executor costs one round. A node with very many neighbours is summed
    by a partial aggregation and joined by its key alone, which adaptive
    execution splits. Null ends are dropped; self loops name single nodes.
    """
    a, b = edges.columns
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
    first = _util.saved(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    now = first.filter("u <> v")
    before, state = None, None
    for _ in range(rounds):
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: larger neighbours to the smallest
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # small star: smaller neighbours, and the node itself, to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        new = _util.saved(small.filter("u <> v").distinct())
        found = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())
        if before is not None:
            _util.drop_saved(before)
        before = now = new
        if found == state:
            break
        state = found
    else:
        raise RuntimeError("the components did not settle")
    # stars name every node of an edge, so nodes are taken from them, not from the edges they came from
    own = now.select("v").distinct().union(first.filter("u = v").select("u"))
    rows = now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(own.select("v", "v"))
    return rows.groupBy("node").agg(F.min("component").alias("component"))
