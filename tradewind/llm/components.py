"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """Per node of `edges(a, b)`: node and root, the least node of its component. Loops are ignored.

    Alternates two steps until nothing changes: each node links its larger neighbours to its least neighbour, then its
    smaller ones. A component becomes a star around its least node in a number of rounds that grows with the logarithm
    of its size. The least neighbour is found by a grouping that combines before it shuffles, so a node with very many
    links is no single task's work. Each round is written, so a lost executor costs a round at most.
    """
    links = written(_down(edges), "links")
    mark = _mark(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        far = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        # A node's link to its own least neighbour, where it has no larger ones, comes from that neighbour's side.
        far = _down(far)
        near = far.groupBy("a").agg(F.min("b").alias("root"))
        links = written(_down(near.select("a", F.col("root").alias("b")).unionByName(far.join(near, "a").select(F.col("b").alias("a"), F.col("root").alias("b")))), "links")
        before, mark = mark, _mark(links)
        if before == mark:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _down(edges: DataFrame) -> DataFrame:
    """Different edges, from the larger node to the smaller."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(links: DataFrame) -> tuple:
    """Equal for equal tables, and for others with next to no chance."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
