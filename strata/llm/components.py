"""Connected components of a graph given by edges, as DataFrame joins.

Alternates the large-star and the small-star step (Kiveris et al., "Connected
components in MapReduce and beyond") until the edges are stars around the
smallest node of each component.  Every round is written to the shared
checkpoint folder; the driver sees two numbers a round.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    kept = down.join(least, "u")
    return kept.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m")).where("a != b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node with an edge but its component's smallest;
    ``edges`` has two columns of one type that can be ordered."""
    now = saved(edges.toDF("a", "b").where("a != b").distinct())
    mark = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == mark:
            return now.toDF("node", "root")
        mark = tuple(state)
        now = saved(_small_star(saved(_large_star(now).distinct())).distinct())
