"""Connected components of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agentlake.operators.paging import skew_join
from agentlake.session import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): its least reachable node.

    Each round replaces a node's links by links to its least neighbour, first
    for the greater neighbours, then for the smaller ones; the number of rounds
    grows with the logarithm of the longest path. Least neighbours are combined
    before the shuffle, and AQE can split the join of a node with many links.
    """
    edges, _, some = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while some:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = skew_join(both, least, ["a"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = skew_join(large, down, ["a"]).select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.*")
        edges, _, _ = written(small.filter("a <> b").distinct(), "links")
        got = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(got) == before:
            break
        before = tuple(got)
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
