"""Connected components of an edge table, by alternating large-star and small-star steps."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.storage import written


def _starred(edges: DataFrame) -> DataFrame:
    """Each node with the smallest of itself and its neighbours, as a table of its own.

    Written, so that the join with the edges of a node with very many of them can be split.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return written(least.select("u", F.least("u", "least").alias("least")), "stars")


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node of ``edges``, columns u and v.

    Each round joins edges with one row a node and drops repeats, so no node's edges meet in one task.
    Rounds grow with the logarithm of the longest path.
    """
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_starred(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        edges = written(large.where("u <> v").distinct(), "large-star")
        stars = _starred(edges)
        small = edges.join(stars, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v")
        edges = written(small.unionByName(stars.select("u", F.col("least").alias("v"))).distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges (member, leader) of a star for each component of a symmetric matrix of links."""
    n = len(linked)
    seen = np.zeros(n, bool)
    edges = []
    for leader in range(n):
        if seen[leader]:
            continue
        seen[leader] = True
        frontier = np.array([leader])
        while len(frontier):
            found = linked[frontier].any(axis=0) & ~seen
            seen |= found
            frontier = np.flatnonzero(found)
            edges += [(int(member), leader) for member in frontier]
    return edges
