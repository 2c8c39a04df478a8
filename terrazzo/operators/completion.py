"""Completion of no-data cells from observed ones, always flagged as inferred.

Nearest neighbours are found by buckets: cells fall into squares of side `reach`, a
query meets the observed cells of its own and the eight squares around it, and what
is nearer than `reach` is final. Cells that found none go on with twice the reach.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .regions import CELL, written


def pairs_within(unknown: DataFrame, known: DataFrame, reach: int, carry: list[str]) -> DataFrame:
    """(y, x, d2, ky, kx, carry): known cells within `reach` of unknown ones."""
    spread = unknown.select(*CELL, F.explode(F.sequence(F.floor(F.col("y") / reach) - 1, F.floor(F.col("y") / reach) + 1)).alias("by"), F.floor(F.col("x") / reach).alias("cx"))
    spread = spread.withColumn("bx", F.explode(F.sequence(F.col("cx") - 1, F.col("cx") + 1))).drop("cx")
    other = known.select(F.col("y").alias("ky"), F.col("x").alias("kx"), *carry).select("*", F.floor(F.col("ky") / reach).alias("by"), F.floor(F.col("kx") / reach).alias("bx"))
    d2 = (F.col("y") - F.col("ky")) * (F.col("y") - F.col("ky")) + (F.col("x") - F.col("kx")) * (F.col("x") - F.col("kx"))
    return spread.join(other, ["by", "bx"]).withColumn("d2", d2).filter(F.col("d2") <= reach * reach).select(*CELL, "d2", "ky", "kx", *carry)


def nearest_fill(values: DataFrame, unknown: DataFrame, *, value: str = "class_id", reach: int = 4) -> DataFrame:
    """(y, x, value, d2, ky, kx) for every unknown cell: its nearest observed cell, ties to the least (y, x)."""
    known = values.filter(F.col(value) > 0).select(*CELL, value)
    left, done = unknown.select(*CELL), None
    if known.isEmpty():
        return unknown.sparkSession.createDataFrame([], f"y int, x int, d2 int, ky int, kx int, {value} int")
    while True:
        best = written(pairs_within(left, known, reach, [value]).groupBy(*CELL).agg(F.min(F.struct("d2", "ky", "kx", value)).alias("e")).select(*CELL, "e.*"))
        done = best if done is None else done.unionByName(best)
        left = written(left.join(best.select(*CELL), CELL, "left_anti"))
        if left.isEmpty():
            return done
        reach *= 2


def neighbour_vote(values: DataFrame, unknown: DataFrame, *, neighbours: int = 16, value: str = "class_id", weight: str | None = None, reach: int = 8) -> DataFrame:
    """(y, x, value, confidence): a vote of the nearest observed cells, weighted by 1 / (d + 0.5)^2, ties to the lower class."""
    carry = [value, *([weight] if weight else [])]
    known = values.filter(F.col(value) > 0).select(*CELL, *carry)
    have, left, near = known.count(), unknown.select(*CELL), None
    need = min(neighbours, have)
    if not need:
        return unknown.sparkSession.createDataFrame([], f"y int, x int, {value} int, confidence int")
    while True:
        order = Window.partitionBy(*CELL).orderBy("d2", "ky", "kx")
        found = written(pairs_within(left, known, reach, carry).withColumn("at", F.row_number().over(order)).filter(F.col("at") <= neighbours))
        full = found.groupBy(*CELL).agg(F.count("*").alias("n")).filter(F.col("n") >= need).select(*CELL)
        part = found.join(full, CELL, "left_semi")
        near = part if near is None else near.unionByName(part)
        left = written(left.join(full, CELL, "left_anti"))
        if left.isEmpty():
            break
        reach *= 2
    d = F.sqrt("d2") + 0.5
    share = 1.0 / (d * d) * (F.coalesce(F.col(weight), F.lit(1.0)) if weight else F.lit(1.0))
    votes = near.groupBy(*CELL, value).agg(F.sum(share).alias("w"))
    best = votes.groupBy(*CELL).agg(F.max(F.struct(F.round("w", 12).alias("w"), (-F.col(value)).alias("k"))).alias("top"), F.sum("w").alias("all"))
    return best.select(*CELL, (-F.col("top.k")).alias(value), F.rint(255 * F.col("top.w") / F.col("all")).cast("int").alias("confidence"))


def fill_boxes(values: DataFrame, boxes: DataFrame, *, pad: int, context: int, share: float, value: str = "class_id") -> DataFrame:
    """(y, x, value): no-data cells in word boxes (seq, left, top, width, height) take the class that holds `share` around the box; the first box counts."""
    grown = boxes.select("seq", (F.col("left") - pad).alias("x0"), (F.col("left") + F.col("width") + pad).alias("x1"), (F.col("top") - pad).alias("y0"), (F.col("top") + F.col("height") + pad).alias("y1"))
    rows = grown.select("*", F.explode(F.sequence(F.col("y0") - context, F.col("y1") + context - 1)).alias("y"))
    near = values.join(rows, "y").filter((F.col("x") >= F.col("x0") - context) & (F.col("x") < F.col("x1") + context))
    inside = (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y1")) & (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1"))
    votes = near.filter(F.col(value) > 0).groupBy("seq", value).agg(F.count("*").alias("n"))
    major = votes.groupBy("seq").agg(F.max(F.struct("n", (-F.col(value)).alias("k"))).alias("top"), F.sum("n").alias("all")).filter(F.col("top.n") >= share * F.col("all"))
    return near.filter(inside & (F.col(value) == 0)).join(major, "seq").groupBy(*CELL).agg(F.min(F.struct("seq", (-F.col("top.k")).alias("k"))).alias("e")).select(*CELL, F.col("e.k").alias(value))
