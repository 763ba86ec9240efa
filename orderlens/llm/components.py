"""Connected components of a link table, without gathering any of it.

Large-star and small-star steps alternate until only stars are left: each node's
neighbours are linked to the smallest of them.  A step is an aggregation, which
combines before its shuffle, and a join; the link table is written once a round.
A forest, whose nodes know their parents, needs less: its paths are halved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch


def _stars(links: DataFrame) -> bool:
    """Whether links (a > b) only lead from nodes with one link to nodes that are their component's smallest."""
    ends = links.select(F.col("a").alias("id"), F.lit(1).alias("n"), F.lit(0).alias("least")).unionByName(
        links.select(F.col("b").alias("id"), F.lit(0).alias("n"), F.lit(1).alias("least")))
    return ends.groupBy("id").agg(F.sum("n").alias("n"), F.max("least").alias("least")).filter("n + least > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b; long) to id, component: the smallest id reachable, for every id that is linked."""
    links = scratch.materialise(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _stars(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.filter("m < a").select("a", F.col("m").alias("b"))).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        links = scratch.materialise(small, "links")
    return (links.select(F.col("a").alias("id"), F.col("b").alias("component"))
            .unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct())


def roots(parents: DataFrame) -> DataFrame:
    """``parents`` (a, b; long), where each a has one parent b and no path returns, to id, component: the
    last node of the path from each a.  Paths are halved by each round."""
    paths = scratch.materialise(parents.select("a", "b", F.lit(True).alias("moved")), "paths")
    while not paths.filter("moved").isEmpty():
        onward = paths.select(F.col("a").alias("b"), F.col("b").alias("next"))
        paths = scratch.materialise(
            paths.select("a", "b").join(onward, "b", "left")
            .select("a", F.coalesce("next", "b").alias("b"), F.col("next").isNotNull().alias("moved")), "paths")
    return paths.select(F.col("a").alias("id"), F.col("b").alias("component"))
