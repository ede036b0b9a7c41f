"""Connected components of an edge table by alternating large-star and small-star rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end (a) of different edges hangs on one smaller end (b) only, which hangs on nothing: then b is the component of a."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up = 1 and down = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in edges (a, b); component is the smallest id that can be reached.

    Large star: every neighbour that is larger than a node is linked to the node's smallest neighbour. Small star: the same for smaller
    neighbours. Rounds end when the edges are stars, which they may be before the first. Smallest neighbours are aggregated with map-side combining, so a hub costs
    one row a task. Each half of a round is written, so that no plan holds both.
    """
    e = checkpoint(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    while not _stars(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = checkpoint(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        e = checkpoint(small)
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
