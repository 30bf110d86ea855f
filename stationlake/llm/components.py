"""Connected components of a graph of links, without any node list in the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import written


def local_forest(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """The smallest node number of each node's component, for links among 0 .. n - 1."""
    label = np.arange(n)
    while len(left):
        a, b = label[left], label[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_ = low != high
        if not open_.any():
            break
        left, right, low, high = left[open_], right[open_], low[open_], high[open_]
        np.minimum.at(label, high, low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
    return label


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` for every linked node; component is the smallest node reachable.

    The graph is contracted round by round: every node is merged into its smallest neighbour, and the
    links between merged nodes are what the next round works on. Most graphs shrink fast; a path whose
    nodes are numbered in order loses one node a round. At the end the rounds' tables are
    chained, the smallest first. Each table is written to the shared folder; only the number of links
    left reaches the driver. Links with a null end and loops are ignored; repeated links count once.
    """
    u, v = F.greatest(F.col(left), F.col(right)), F.least(F.col(left), F.col(right))
    usable = F.col(left).isNotNull() & F.col(right).isNotNull()
    edges = written(links.where(usable).select(u.alias("u"), v.alias("v")).where("u != v").distinct(), "links")
    rounds = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("v"))
        merged = written(least.select(F.col("u").alias("node"), F.least("u", "v").alias("component")), "merged")
        rounds.append(merged)
        one = edges.join(merged.toDF("u", "a"), "u")
        two = one.join(merged.toDF("v", "b"), "v").where("a != b")
        edges = written(two.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    if not rounds:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = rounds.pop()
    while rounds:
        found = rounds.pop().join(found.toDF("component", "last"), "component", "left").select(
            "node", F.coalesce("last", "component").alias("component")
        )
    return found
