"""Tile pyramids: pixel-centre sampling at full zoom, supersampled overviews below."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tile_counts(west: float, south: float, east: float, north: float, zooms: range) -> list[int]:
    """Tiles of each zoom that a WGS84 box touches."""
    import math

    out = []
    for z in zooms:
        n = 1 << z
        place = lambda lon, lat: ((lon + 180) / 360 * n, (1 - math.asinh(math.tan(math.radians(lat))) / math.pi) / 2 * n)  # noqa: E731, B023
        (x0, y0), (x1, y1) = place(west, north), place(east, south)
        out.append((math.ceil(x1 - 1e-9) - math.floor(x0 + 1e-9)) * (math.ceil(y1 - 1e-9) - math.floor(y0 + 1e-9)))
    return out


def sample(values: DataFrame, out_height: int, out_width: int, height: int, width: int, targets: DataFrame) -> DataFrame:
    """Values at the pixel centres of another grid, by floor."""
    at = lambda c, out, n: F.floor((F.col(c) + 0.5) * n / out).cast("int")
    wanted = targets.select(F.col("y").alias("ty"), F.col("x").alias("tx"), at("y", out_height, height).alias("y"), at("x", out_width, width).alias("x"))
    return wanted.join(values, ["y", "x"]).drop("y", "x").withColumnsRenamed({"ty": "y", "tx": "x"})


def dominant(values: DataFrame, factor: int, value: str = "class_id") -> DataFrame:
    """Overview cells of factor x factor: the most frequent class but 0 (ties to the lower) and alpha of the covered share."""
    counts = values.filter(F.col(value) > 0).groupBy((F.floor(F.col("y") / factor)).cast("int").alias("ty"), (F.floor(F.col("x") / factor)).cast("int").alias("tx"), value).agg(F.count("*").alias("n"))
    best = counts.groupBy("ty", "tx").agg(F.max(F.struct("n", (-F.col(value)).alias("k"))).alias("b"), F.sum("n").alias("covered"))
    return best.select("ty", "tx", (-F.col("b.k")).alias(value), F.rint(255.0 * F.col("covered") / (factor * factor)).cast("int").alias("alpha"))


def mean_colour(pixels: DataFrame, factor: int, valid: Column) -> DataFrame:
    """Overview colours: sums over valid cells cut to whole numbers, alpha rounded."""
    cells = pixels.filter(valid).groupBy(F.floor(F.col("y") / factor).cast("int").alias("ty"), F.floor(F.col("x") / factor).cast("int").alias("tx"))
    sums = cells.agg(*[F.sum(c).alias(c) for c in "rgb"], F.count("*").alias("n"))
    return sums.select("ty", "tx", *[F.floor(F.col(c) / F.col("n")).cast("int").alias(c) for c in "rgb"], F.rint(255.0 * F.col("n") / (factor * factor)).cast("int").alias("alpha"))


def pyramid(values: DataFrame, zooms: int, value: str = "class_id") -> DataFrame:
    """(level, ty, tx, class, alpha) of all overviews, each from the full grid, so that shares stay exact."""
    parts = [dominant(values, 1 << k, value).withColumn("level", F.lit(k)) for k in range(zooms)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
