"""Joins of layers on cells: precedence, clipping, masks, signatures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = ["y", "x"]


def compose(layers: list[tuple[str, DataFrame]], value: str = "class_id") -> DataFrame:
    """The first layer that has data at a cell gives its value; `origin` names the layer."""
    parts = [d.filter(F.col(value) > 0).select(*CELL, F.struct(F.lit(k).alias("k"), F.lit(name).alias("origin"), F.col(value).alias(value)).alias("e")) for k, (name, d) in enumerate(layers)]
    best = reduce(DataFrame.unionByName, parts).groupBy(*CELL).agg(F.min("e").alias("e"))
    return best.select(*CELL, F.col(f"e.{value}").alias(value), "e.origin")


def conservative(first: DataFrame, second: DataFrame, value: str = "class_id") -> DataFrame:
    """First-pass values, then second-pass ones; fails if the second pass touches a cell that the first holds."""
    both = first.filter(F.col(value) > 0).select(*CELL, F.col(value).alias("a")).join(second.filter(F.col(value) > 0).select(*CELL, F.col(value).alias("b")), CELL, "full_outer")
    checked = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.raise_error(F.lit("second pass overlaps approved evidence"))).otherwise(F.coalesce("a", "b"))
    return both.select(*CELL, checked.alias(value))


def clip(values: DataFrame, interior: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(inside, removed) cells of a raster against an interior mask."""
    return values.join(interior.select(*CELL), CELL, "left_semi"), values.join(interior.select(*CELL), CELL, "left_anti")


def partition_unknown(cells: DataFrame, seed: str, audited: str, inside: str) -> DataFrame:
    """Adds `part`: what an unknown cell is to a completion."""
    unknown = F.col(seed) == 0
    part = F.when(unknown & F.col(inside) & F.col(audited), "inside").when(unknown & F.col(audited), "audited_outside").when(unknown & F.col(inside), "additional")
    return cells.withColumn("part", part)


def signature(flags: list[str]) -> Column:
    """A bit for each flag that holds."""
    return reduce(lambda a, b: a + b, [F.when(F.col(f), F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(flags)])


def iou(a: Column, b: Column) -> Column:
    """Intersection over union as an aggregate; null where both are empty."""
    union = F.sum((a | b).cast("int"))
    return F.when(union > 0, F.sum((a & b).cast("int")) / union)


def disc_cells(stamps: DataFrame, radius: str = "radius") -> DataFrame:
    """Cells of discs (cy, cx, radius), offsets added: dy, dx."""
    r = F.ceil(radius).cast("int")
    spread = stamps.withColumn("dy", F.explode(F.sequence(-r, r))).withColumn("dx", F.explode(F.sequence(-r, r)))
    return spread.filter(F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx") <= F.col(radius) * F.col(radius))


def stamp(values: DataFrame, operations: DataFrame, value: str = "class_id") -> DataFrame:
    """Circular copies (seq, sy, sx, ty, tx, radius) of observed cells; the last operation at a cell counts, zeros are copied too."""
    cells = disc_cells(operations).select("seq", (F.col("sy") + F.col("dy")).alias("fy"), (F.col("sx") + F.col("dx")).alias("fx"), (F.col("ty") + F.col("dy")).alias("y"), (F.col("tx") + F.col("dx")).alias("x"))
    source = values.select(F.col("y").alias("fy"), F.col("x").alias("fx"), F.col(value).alias("copied"))
    last = cells.join(source, ["fy", "fx"]).groupBy(*CELL).agg(F.max_by("copied", "seq").alias("copied"))
    return values.join(last, CELL, "left").withColumn(value, F.coalesce("copied", value)).drop("copied")


def replay(values: DataFrame, operations: list[dict], value: str = "class_id") -> DataFrame:
    """Copies in order, each reading what those before it painted."""
    spark = values.sparkSession
    for k, o in enumerate(operations):
        one = spark.createDataFrame([(k, *o["source"], *o["target"], float(o["radius"]))], "seq int, sy int, sx int, ty int, tx int, radius double")
        values = stamp(values, one, value)
    return values


def erase(values: DataFrame, brushes: DataFrame, origin: str = "inferred") -> DataFrame:
    """Cells of one origin under circular brushes (cy, cx, radius) go."""
    gone = disc_cells(brushes).select((F.col("cy") + F.col("dy")).alias("y"), (F.col("cx") + F.col("dx")).alias("x")).distinct().withColumn("_gone", F.lit(True))
    return values.join(gone, CELL, "left").filter(F.col("_gone").isNull() | (F.col("origin") != origin)).drop("_gone")
