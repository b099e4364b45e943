"""Connected components of a link table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stash

#: Rounds before giving up; each at least halves the length of the longest chain.
MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node of the component of every linked node.

    ``links`` has ``a`` and ``b``. Alternates two steps until all links are stars around their
    smallest node: every node's larger neighbours are linked to its smallest neighbour, then its
    smaller ones are. Links never multiply, and a hub only ever meets aggregates.
    """
    pairs = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    pairs = stash(pairs.distinct(), "links")
    for _ in range(MOST_ROUNDS):
        both = pairs.union(pairs.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("_m"))
        least = least.select(F.col("a").alias("_a"), F.least("a", "_m").alias("_m"))
        large = both.join(least, F.col("a") == F.col("_a")).where("b > a")
        large = large.select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()
        large = stash(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("_m"))
        least = least.withColumnRenamed("a", "_a")
        small = large.join(least, F.col("a") == F.col("_a"))
        small = small.select(
            F.explode(
                F.array(
                    F.struct(F.col("a"), F.col("_m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("_m").alias("b")),
                )
            ).alias("_l")
        ).select("_l.*").where("a <> b")
        pairs = stash(small.distinct(), "links")
        ends = pairs.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above"))
        ends = ends.union(pairs.select("b", F.lit(0), F.lit(1)))
        roles = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
        if roles.where("below + above > 1").isEmpty():
            break
    tree = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return tree.union(roots)


def forest(count: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links: what connects, without what closes a ring."""
    parent = list(range(count))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in zip(left.tolist(), right.tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept
