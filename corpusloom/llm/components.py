"""Connected components of links that may be as many as the corpus has texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import durable, written


def local_roots(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """The smallest member of each member's component among 0..n-1, under the links a-b and those already in ``root``."""
    root = np.arange(n) if root is None else root
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == root).all():
            return root
        root = new


def _lowest(edges: DataFrame) -> DataFrame:
    """(a, low), written: a join with it has plain shuffles on both sides, which Spark splits where a node has very many links."""
    return durable(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("low")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b: comparable ids); root is the smallest node it reaches.

    Alternating large-star and small-star rounds, each a minimum and a join. Minima are made in part before the shuffle,
    and the adaptive join splits a node with very many links over several tasks. Empty links give no rows; repeated links
    and self-links are harmless.
    """
    edges, folder = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _lowest(both)
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = durable(large.distinct())
        low = _lowest(large)
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        edges, folder = written(small.filter("a <> b").distinct(), instead_of=folder)
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
