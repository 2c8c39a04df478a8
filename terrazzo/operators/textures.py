"""Classes told by texture or by small marks, and gaps that one class encloses."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .classify import Prototype, classify
from .masks import centroids
from .regions import CELL, component_stats, components


def texture_model(features: DataFrame, label: str, columns: list[str], *, least: float = 1.0) -> tuple[list[Prototype], dict[int, float], list[tuple[int, int, float]]]:
    """(centres, robust radii, ambiguous pairs) of swatches: medians by column, the median distance plus three median deviations, and classes nearer than `least`.

    The driver holds one row a class.
    """
    middle = features.groupBy(label).agg(*[F.percentile(c, F.lit(0.5)).alias(f"_{c}") for c in columns])
    off = features.join(F.broadcast(middle), label).withColumn("_d", F.sqrt(sum(((F.col(c) - F.col(f"_{c}")) * (F.col(c) - F.col(f"_{c}")) for c in columns), F.lit(0.0))))
    near = off.groupBy(label).agg(F.percentile("_d", F.lit(0.5)).alias("_m"))
    spread = off.join(F.broadcast(near), label).groupBy(label).agg(F.first("_m").alias("m"), F.percentile(F.abs(F.col("_d") - F.col("_m")), F.lit(0.5)).alias("mad"))
    rows = middle.join(spread, label).orderBy(label).collect()
    centres = [(r[label], tuple(r[f"_{c}"] for c in columns)) for r in rows]
    close = [(a, b, d) for i, (a, p) in enumerate(centres) for b, q in centres[i + 1 :] if (d := math.dist(p, q)) < least]
    return centres, {r[label]: r["m"] + 3 * r["mad"] for r in rows}, close


def classify_texture(features: DataFrame, columns: list[str], model: tuple, *, max_distance: float, min_margin: float) -> DataFrame:
    """Nearest texture centre with both gates; a model with ambiguous classes raises."""
    centres, _, close = model
    if close:
        raise ValueError(f"swatches can't be told apart: {close}")
    return classify(features, columns, centres, max_distance=max_distance, min_margin=min_margin)


def learned_prototypes(samples: DataFrame, label: str, columns: list[str], *, step: float = 4.0, most: int = 64) -> DataFrame:
    """(label, rank, columns): the most frequent quantised values of each class's seeds, ties to the lower bin."""
    bins = samples.groupBy(label, *[F.rint(F.col(c) / step).cast("int").alias(c) for c in columns]).agg(F.count("*").alias("n"))
    ranked = bins.withColumn("rank", F.row_number().over(Window.partitionBy(label).orderBy(F.desc("n"), *columns))).filter(F.col("rank") <= most)
    return ranked.select(label, "rank", "n", *[F.least(F.greatest(F.col(c) * step, F.lit(0.0)), F.lit(255.0)).alias(c) for c in columns])


def dot_pattern(marks: DataFrame, *, area: int, side: int, radius: int, quadrants: int, least: int, window: int, crowd: int, gap: int = 2) -> DataFrame:
    """Cells of small marks that have marks around them in several quadrants, where marks are dense: a hatch, no line and no label."""
    cells = components(marks.select(*CELL), 8)
    small = component_stats(cells).filter((F.col("area") <= area) & (F.col("right") - F.col("left") < side) & (F.col("bottom") - F.col("top") < side)).select("label")
    kept = cells.join(small, "label")
    middle = centroids(kept).select("label", F.rint("cy").cast("int").alias("cy"), F.rint("cx").cast("int").alias("cx"))
    # Marks and centres meet in squares of the radius.
    square = lambda c, k=0: F.floor(F.col(c) / radius) + k
    a = middle.select("*", F.explode(F.sequence(square("cy", -1), square("cy", 1))).alias("by"), square("cx").alias("mx")).withColumn("bx", F.explode(F.sequence(F.col("mx") - 1, F.col("mx") + 1)))
    b = kept.select("y", "x", square("y").alias("by"), square("x").alias("bx"))
    dy, dx = F.col("y") - F.col("cy"), F.col("x") - F.col("cx")
    low, high = (lambda d: (d >= -radius) & (d < -gap)), (lambda d: (d >= gap) & (d < radius))
    at = F.when(low(dy) & low(dx), 0).when(low(dy) & high(dx), 1).when(high(dy) & low(dx), 2).when(high(dy) & high(dx), 3)
    met = a.join(b, ["by", "bx"]).select("label", at.alias("q")).filter("q is not null").groupBy("label", "q").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    good = met.groupBy("label").agg(F.count("*").alias("k")).filter(F.col("k") >= quadrants).select("label")
    half = window // 2
    near = shifted(kept, [(dy, dx) for dy in range(-half, half + 1) for dx in range(-half, half + 1)])
    dense = near.groupBy(*CELL).agg(F.count("*").alias("n")).filter(F.col("n") >= crowd).select(*CELL)
    return kept.join(good, "label", "left_semi").join(dense, CELL, "left_semi").select(*CELL, "label")


def ellipse(radius: int) -> list[tuple[int, int]]:
    """Offsets (dy, dx) of a round element: a row's half width is the circle's, rounded half to even."""
    return [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if abs(dx) <= round(math.sqrt(radius * radius - dy * dy))]


def shifted(cells: DataFrame, offsets: list[tuple[int, int]], *carry: str) -> DataFrame:
    """Every cell at every offset."""
    o = F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in offsets])).alias("o")
    return cells.select(*CELL, *carry, o).select((F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"), *carry)


def inside(height: int, width: int) -> Column:
    return F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1)


def small_gaps(values: DataFrame, height: int, width: int, *, radius: int = 6, area: int = 1200, side: int = 120, ring: int = 3, least: int = 12, share: float = 0.98, value: str = "class_id") -> DataFrame:
    """(y, x, value) of no-data cells in narrow gaps that one class encloses; `values` holds the valid cells, no data as 0.

    A class's closing proposes gaps; they must be small and their surroundings nearly
    all of the class. Cells that two classes claim stay empty.
    """
    element = ellipse(radius)
    seen = values.filter(F.col(value) > 0).select(*CELL, F.col(value).alias("k"))
    fat = shifted(seen, element, "k").filter(inside(height, width)).distinct()
    # Closed: every cell of the element around it that lies in the frame is in the dilation.
    hit = shifted(fat, element, "k").filter(inside(height, width)).groupBy(*CELL, "k").agg(F.count("*").alias("n"))
    frame = sum(((F.col("y") + dy).between(0, height - 1) & (F.col("x") + dx).between(0, width - 1)).cast("int") for dy, dx in element)
    closed = hit.filter(F.col("n") == frame).select(*CELL, "k")
    gaps = closed.join(values.filter(F.col(value) == 0).select(*CELL), CELL)
    # One raster a class: rows of classes lie `height + 2` apart, so that components don't touch.
    apart = gaps.select((F.col("y") + F.col("k") * (height + 2)).alias("y"), "x", "k")
    cells = components(apart.select(*CELL, "k"), 8, same="k").select((F.col("y") - F.col("k") * (height + 2)).alias("y"), "x", "k", "label")
    stats = cells.groupBy("label", "k").agg(F.count("*").alias("area"), F.greatest(F.max("y") - F.min("y"), F.max("x") - F.min("x")).alias("extent"))
    fits = stats.filter((F.col("area") <= area) & (F.col("extent") < side)).select("label")
    cells = cells.join(fits, "label", "left_semi")
    around = shifted(cells, ellipse(ring), "label", "k").distinct().join(cells.select("label", *CELL), ["label", *CELL], "left_anti")
    votes = around.join(seen.withColumnRenamed("k", "v"), CELL).groupBy("label").agg(F.count("*").alias("n"), F.avg((F.col("v") == F.col("k")).cast("double")).alias("same"))
    good = cells.join(votes.filter((F.col("n") >= least) & (F.col("same") >= share)).select("label"), "label", "left_semi")
    return good.groupBy(*CELL).agg(F.min("k").alias("low"), F.max("k").alias("high")).filter("low = high").select(*CELL, F.col("low").alias(value))
