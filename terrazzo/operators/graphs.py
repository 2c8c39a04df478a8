"""Connected components of edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import dealt, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component: its least node.

    Alternating stars: larger neighbours move to the least of a node's neighbours and
    itself, then a node and its smaller ones to the least of them. Rounds follow the
    logarithm of a component's extent, each is written out, and none is left out.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    now, seen = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(dealt(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(dealt(down), "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b")))
        now = written(small.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    return nodes.join(dealt(now.select(F.col("a").alias("node"), F.col("b").alias("component"))), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
