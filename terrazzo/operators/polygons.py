"""Polygons to cells: scan lines at cell centres, even-odd rule, so holes are rings like any other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def edges(rings: DataFrame, key: str = "polygon") -> DataFrame:
    """(key, x0, y0, x1, y1) of rings given as (key, ring, at, px, py) points; rings close themselves."""
    w = Window.partitionBy(key, "ring").orderBy("at")
    whole = Window.partitionBy(key, "ring").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt = F.coalesce(F.lead(F.struct("px", "py")).over(w), F.first(F.struct("px", "py")).over(whole))
    return rings.withColumn("_n", nxt).select(key, F.col("px").alias("x0"), F.col("py").alias("y0"), F.col("_n.px").alias("x1"), F.col("_n.py").alias("y1"))


def rasterise(rings: DataFrame, height: int, width: int, *, key: str = "polygon", centre: float = 0.5) -> DataFrame:
    """(key, y, x) of the cells whose centre lies inside; `centre` is the offset of a cell's centre."""
    e = edges(rings, key).filter(F.col("y0") != F.col("y1"))
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    first = F.greatest(F.ceil(low - centre), F.lit(0)).cast("int")
    last = F.least(F.ceil(high - centre) - 1, F.lit(height - 1)).cast("int")
    rows = e.withColumns({"_a": first, "_b": last}).filter("_a <= _b").withColumn("y", F.explode(F.sequence("_a", "_b")))
    x = F.col("x0") + (F.col("y") + centre - F.col("y0")) * (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))
    cuts = rows.select(key, "y", x.alias("cut")).groupBy(key, "y").agg(F.array_sort(F.collect_list("cut")).alias("cuts"))
    spans = cuts.withColumn("_k", F.explode(F.sequence(F.lit(0), F.floor(F.size("cuts") / 2).cast("int") - 1)))
    left, right = F.get("cuts", 2 * F.col("_k")), F.get("cuts", 2 * F.col("_k") + 1)
    cells = spans.select(key, "y", F.greatest(F.ceil(left - centre), F.lit(0)).cast("int").alias("_l"), F.least(F.ceil(right - centre) - 1, F.lit(width - 1)).cast("int").alias("_r")).filter("_l <= _r")
    return cells.select(key, "y", F.explode(F.sequence("_l", "_r")).alias("x")).distinct()


def coverage(rings: DataFrame, height: int, width: int, factor: int, *, key: str = "polygon") -> DataFrame:
    """(key, y, x, share): the share of factor x factor subcells of each cell that lie inside."""
    fine = rings.withColumns({"px": F.col("px") * factor, "py": F.col("py") * factor})
    cells = rasterise(fine, height * factor, width * factor, key=key)
    return cells.groupBy(key, F.floor(F.col("y") / factor).cast("int").alias("y"), F.floor(F.col("x") / factor).cast("int").alias("x")).agg((F.count("*") / (factor * factor)).alias("share"))
