"""Connected components of a distributed edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heddle.llm.shared import drop, stored


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and edges a-b: the smallest node that each reaches."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]
    return root


def _stars(edges: DataFrame) -> bool:
    """Whether each node of ``edges`` (a > b) either leads to one other or is only led to."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.union(edges.select(F.col("b").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out + into > 1").isEmpty()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node long, root long) for every node of ``edges`` (a long, b long): root is the smallest node reachable.

    Alternates the two star steps of Kiveris et al., "Connected Components in
    MapReduce and Beyond": each is an aggregate of minima and a join with it.
    A join's skewed side is a plain scan, so that adaptive execution can split
    a hub. It ends when the edges are stars. Loops and rows with a null end are dropped; repeats don't matter; an
    edge table without rows gives no rows.
    """
    at = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(max_rounds):
        if _stars(at):
            break
        # large star: every larger neighbour of a node moves to the smallest of the node and its neighbours
        both = at.union(at.select("b", "a"))
        low = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m")), "low")
        large = stored(both.join(low, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "edges")
        # small star: a node and its smaller neighbours move to the smallest of these
        small = stored(large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m"), "low")
        moved = large.join(small, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        after = stored(moved.union(small.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
        drop(at, low, large, small)
        at = after
    else:
        raise RuntimeError(f"no end after {max_rounds} rounds")
    roots = at.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return at.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
