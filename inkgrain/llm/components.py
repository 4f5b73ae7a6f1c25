"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b``; long): the smallest node reachable.

    Large-star and small-star steps until nothing changes: a number of rounds that grows with the logarithm of the nodes.
    Minima combine on the map side; the first table of minima is written, so that adaptive execution can split the edges of a hub.
    """
    now = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = written(now, "edges")
    while not flat(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).where("a != b")
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        now = written(small, "edges")
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def flat(edges: DataFrame) -> bool:
    """Whether every node has one edge, and that leads to a node that has none: to its component's smallest node."""
    seen = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per = seen.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.where("up > 1 OR up = 1 AND down = 1").isEmpty()
