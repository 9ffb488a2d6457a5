"""Connected components of a graph given by its edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.tables import stored


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 of one task, the smallest node of each node's component."""
    root = np.arange(n)
    while True:
        one, other = root[a], root[b]
        apart = one != other
        if not apart.any():
            return root
        a, b, one, other = a[apart], b[apart], one[apart], other[apart]
        np.minimum.at(root, np.maximum(one, other), np.minimum(one, other))
        while not np.array_equal(up := root[root], root):
            root = up


def components(edges: DataFrame) -> DataFrame:
    """The component of every node of ``edges`` (a, b): rows (node, component), the component's smallest node.

    Large-star and small-star steps in turn until nothing changes. Each step
    needs the smallest neighbour of a node only, so no neighbourhood is ever
    gathered; a hot node's rows are dealt out by the skew join. Each round is
    stored. An empty table gives an empty table.
    """
    links = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before or seen[0] == 0:
            break
        before = seen
        ways = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b"), F.col("a")))
        low = ways.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = ways.join(low, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select("b", "b").distinct())
