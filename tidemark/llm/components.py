"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import drop, saved


def _star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the least of its neighbours and itself; then the same among smaller ones.

    Minima are aggregates and come back by a join, so that a node with very many neighbours is never in one task.
    """
    ways = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = ways.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    down = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(down, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(down.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the least node of its component) for each node that has an edge but the least itself.

    ``edges``: ``a``, ``b``, in any order and repeated or not; loops and edges with a null count for nothing.
    """
    now = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    figure = None
    while True:
        after = saved(_star(now))
        new = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop(now)
        now = after
        if new == figure or not new[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        figure = new
