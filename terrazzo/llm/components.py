"""Connected components of an edge list, by alternating stars.

Each step is a minimum per node and a join back, both dealt by node with partial
aggregation, so a node with very many edges is no group that one task holds. Steps
are written to the shared folder, which keeps the lineage short.

A graph of at most SMALL edges between integers is solved at once on the driver, with
the same result: each step there costs some plans and jobs, whose compiled code and
records stay in the driver's memory, whatever the number of edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from . import common

#: Edges that the driver takes, at most: two numbers each, so 2 MB.
SMALL = 1 << 17


def large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours go to the least of a node's neighbours and itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the least of them; edges come as (larger, smaller)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the least node that each reaches by edges (a, b): roots hook to smaller ones, then paths are shortened."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while (apart := root[a] != root[b]).any():
        a, b = a[apart], b[apart]
        x, y = root[a], root[b]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (further := root[root] != root).any():
            root = np.where(further, root[root], root)
    return nodes, nodes[root]


def components(edges: DataFrame, many: int) -> DataFrame:
    """(node, component) for every node with an edge, of which there are so many; component: its least node."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    kind = pairs.schema["a"].dataType
    if many > SMALL or not isinstance(kind, IntegralType):
        return by_stars(pairs)
    few = pairs.toArrow()
    nodes, least = least_reached(few["a"].to_numpy(), few["b"].to_numpy())
    return edges.sparkSession.createDataFrame(pa.table({"node": nodes, "component": least}), f"node {kind.simpleString()}, component {kind.simpleString()}")


def by_stars(pairs: DataFrame) -> DataFrame:
    """The same for edges (larger, smaller) in any number."""
    now = common.stored(pairs.distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        now = common.stored(small_star(large_star(now)), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
