"""Masks that rest on the shape of connected components, and algebra of evidence.

A mask is a table of its cells (y, x). Components come from `regions`; what is kept
of them is decided by one row a component.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import dealt
from .completion import nearest_fill
from .regions import CELL, component_stats, components
from .stencils import dilated, frames


def blue_water(r: Column, g: Column, b: Column) -> Column:
    """Saturated blue."""
    return (b >= 95) & (b - r >= 35) & (b - g >= 18) & (g - r >= 8)


def saturated_stroke(h: Column, s: Column, v: Column) -> Column:
    """Blue printed strokes, in 8-bit HSV; the pale sea is left out by its saturation."""
    return h.between(85, 125) & (s >= 60) & (v >= 55)


def shaped(mask: DataFrame, keep: Column, connectivity: int = 8) -> DataFrame:
    """Cells of the components whose statistics (area, top, bottom, left, right, width, height) meet `keep`, with `label`."""
    cells = components(mask.select(*CELL), connectivity)
    stats = component_stats(cells).withColumns({"width": F.col("right") - F.col("left") + 1, "height": F.col("bottom") - F.col("top") + 1})
    return cells.join(stats.filter(keep).select("label"), "label", "left_semi").select(*CELL, "label")


def touches(height: int, width: int) -> Column:
    """Whether a component lies at the frame."""
    return (F.col("top") == 0) | (F.col("left") == 0) | (F.col("bottom") == height - 1) | (F.col("right") == width - 1)


def border_connected(mask: DataFrame, height: int, width: int, *, least: int = 24, share: float = 0.0015) -> DataFrame:
    """Components that touch the frame and aren't small: water that runs out of the picture."""
    return shaped(mask, touches(height, width) & (F.col("area") >= max(least, round(height * width * share))))


def framed_closing(mask: DataFrame, height: int, width: int) -> DataFrame:
    """A 3 x 3 closing within the frame: what is beyond it neither grows in nor shrinks out."""
    fat = dilated(mask.select(*CELL), 1).filter(F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1))
    side = lambda c, size: F.lit(3) - (F.col(c) == 0).cast("int") - (F.col(c) == size - 1).cast("int")
    full = frames(fat, 1, {"_n": (F.lit(1), F.sum)})
    return full.filter(F.col("_n") == side("y", height) * side("x", width)).select(*CELL)


def long_lines(mask: DataFrame, height: int, width: int, *, share: float = 0.08, least: int = 12) -> DataFrame:
    """Components of the closed mask that are as long as a share of the frame: strokes, not glyphs."""
    long = (F.col("width") >= width * share) | (F.col("height") >= height * share)
    return shaped(framed_closing(mask, height, width), (F.col("area") >= least) & long)


def compact_ink(ink: DataFrame, corridor: DataFrame) -> DataFrame:
    """Components of the size of glyphs that lie in a corridor for the most part; a river that crosses it stays out."""
    cells = components(ink.select(*CELL), 8)
    inside = cells.join(corridor.select(*CELL).distinct(), CELL, "left_semi").groupBy("label").agg(F.count("*").alias("inside"))
    stats = component_stats(cells).join(inside, "label")
    w, h = F.col("right") - F.col("left") + 1, F.col("bottom") - F.col("top") + 1
    glyph = F.col("area").between(3, 240) & (F.greatest(w, h) <= 32) & (F.greatest(w, h) <= 6.0 * F.least(w, h)) & (F.col("area") >= 0.08 * w * h) & (F.col("inside") >= 0.7 * F.col("area"))
    return cells.join(stats.filter(glyph).select("label"), "label", "left_semi")


def centroids(labelled: DataFrame) -> DataFrame:
    """Statistics of each component with its centre (cy, cx)."""
    return labelled.groupBy("label").agg(F.count("*").alias("area"), F.avg("y").alias("cy"), F.avg("x").alias("cx"), F.min("y").alias("top"), F.max("y").alias("bottom"), F.min("x").alias("left"), F.max("x").alias("right"))


def near_points(points: DataFrame, low: float, high: float) -> DataFrame:
    """(label, dy, dx) of the points (label, cy, cx) from `low` to `high` away, by squares of side `high`."""
    square = lambda c, k=0: F.floor(F.col(c) / high) + k
    a = points.select("label", "cy", "cx", F.explode(F.sequence(square("cy", -1), square("cy", 1))).alias("by"), square("cx").alias("mx")).withColumn("bx", F.explode(F.sequence(F.col("mx") - 1, F.col("mx") + 1)))
    b = points.select(F.col("cy").alias("oy"), F.col("cx").alias("ox"), square("cy").alias("by"), square("cx").alias("bx"))
    pairs = a.join(b, ["by", "bx"]).select("label", (F.col("oy") - F.col("cy")).alias("dy"), (F.col("ox") - F.col("cx")).alias("dx"))
    d2 = F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx")
    return pairs.filter((d2 >= low * low) & (d2 <= high * high))


def dotted_chains(mask: DataFrame, *, near: float = 3.0, far: float = 42.0, anisotropy: float = 3.0) -> DataFrame:
    """(label, anisotropy) of small components whose neighbours lie along one direction."""
    stats = centroids(components(mask.select(*CELL), 8)).filter("area between 2 and 90 and right - left < 20 and bottom - top < 20")
    sums = near_points(stats, near, far).groupBy("label").agg(F.count("*").alias("n"), F.avg(F.col("dy") * F.col("dy")).alias("yy"), F.avg(F.col("dx") * F.col("dx")).alias("xx"), F.avg(F.col("dy") * F.col("dx")).alias("xy"))
    root = F.sqrt((F.col("xx") - F.col("yy")) * (F.col("xx") - F.col("yy")) / 4 + F.col("xy") * F.col("xy"))
    ratio = ((F.col("xx") + F.col("yy")) / 2 + root) / F.greatest((F.col("xx") + F.col("yy")) / 2 - root, F.lit(0.25))
    return sums.filter("n >= 2").select("label", ratio.alias("anisotropy")).filter(F.col("anisotropy") >= anisotropy)


def isolated_dots(mask: DataFrame, *, width: int, height: int, area: int, reach: float, neighbours: int = 2) -> DataFrame:
    """Small round components with at least so many others of the kind within `reach`: printed dots."""
    stats = centroids(components(mask.select(*CELL), 8))
    w, h = F.col("right") - F.col("left") + 1, F.col("bottom") - F.col("top") + 1
    dots = stats.filter((w <= width) & (h <= height) & (F.col("area") <= area) & (F.greatest(w, h) <= 1.5 * F.least(w, h)))
    met = near_points(dots, 1e-9, reach).groupBy("label").agg(F.count("*").alias("neighbours")).filter(F.col("neighbours") >= neighbours)
    return dots.join(met, "label").select("label", "area", "cy", "cx", "neighbours")


def pin_points(labelled: DataFrame) -> DataFrame:
    """(label, pin, y, x): the centre of each component and its four extreme cells, each the one next to the centre; of pins that round to one cell the first stays."""
    told = labelled.join(centroids(labelled), "label")

    def extreme(k: int, name: str, axis: str, edge: str, other: str, centre: str) -> DataFrame:
        there = told.filter(F.col(axis) == F.col(edge))
        best = there.groupBy("label").agg(F.min(F.struct(F.abs(F.col(other) - F.col(centre)).alias("d"), F.col(other).alias("o"), F.col(axis).alias("e"))).alias("b"))
        y, x = ("b.e", "b.o") if axis == "y" else ("b.o", "b.e")
        return best.select("label", F.lit(k).alias("k"), F.lit(name).alias("pin"), F.col(y).cast("double").alias("y"), F.col(x).cast("double").alias("x"))

    pins = told.select("label", F.lit(0).alias("k"), F.lit("center").alias("pin"), F.col("cy").alias("y"), F.col("cx").alias("x")).distinct()
    for k, (name, axis, edge, other, centre) in enumerate((("west", "x", "left", "y", "cy"), ("east", "x", "right", "y", "cy"), ("north", "y", "top", "x", "cx"), ("south", "y", "bottom", "x", "cx")), 1):
        pins = pins.unionByName(extreme(k, name, axis, edge, other, centre))
    first = pins.groupBy("label", F.rint("y").alias("ry"), F.rint("x").alias("rx")).agg(F.min(F.struct("k", "pin", "y", "x")).alias("p"))
    return first.select("label", "p.pin", "p.y", "p.x")


def filled_holes(mask: DataFrame, height: int, width: int, *, least: int = 8, share: float = 0.0012) -> DataFrame:
    """The mask with its small holes: components of the complement that touch no edge."""
    spark = mask.sparkSession
    # The grid itself, by rows; `mask` may hold any part of it.
    grid = spark.range(height).select(F.col("id").cast("int").alias("y"), F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("x"))
    holes = shaped(grid.join(mask.select(*CELL), CELL, "left_anti"), ~touches(height, width) & (F.col("area") <= max(least, round(height * width * share))))
    return mask.select(*CELL).unionByName(holes.select(*CELL))


def distance_to(cells: DataFrame, mask: DataFrame) -> DataFrame:
    """`cells` with d2: the squared distance to the nearest cell of `mask`; none where the mask is empty."""
    near = nearest_fill(mask.select(*CELL).withColumn("class_id", F.lit(1)), cells.select(*CELL).distinct())
    return cells.join(near.select(*CELL, "d2"), CELL)


def geographic_support(mask: DataFrame, height: int, width: int, *, gap: float = 7.0) -> DataFrame:
    """The largest component of the closed mask with the satellites that are large and near enough, small holes filled."""
    cells = components(framed_closing(mask, height, width), 8)
    stats = component_stats(cells).withColumn("extent", F.greatest(F.col("right") - F.col("left"), F.col("bottom") - F.col("top")) + 1)
    main = stats.orderBy(F.desc("area"), "label").limit(1).select(F.col("label").alias("main"), F.col("area").alias("main_area"), F.col("extent").alias("main_extent"))
    told = cells.join(stats.select("label", "area"), "label").crossJoin(F.broadcast(main))  # one row
    others = distance_to(told.filter("label <> main"), told.filter("label = main"))
    enough = (F.col("area") >= F.greatest(F.lit(5.0), F.rint(F.col("main_area") * 0.00015))) & (F.sqrt("nearest") <= F.greatest(F.lit(gap), F.col("main_extent") * 0.04))
    good = others.groupBy("label", "area", "main_area", "main_extent").agg(F.min("d2").alias("nearest")).filter(enough).select("label")
    kept = told.filter("label = main").select(*CELL).unionByName(told.join(good, "label", "left_semi").select(*CELL))
    return filled_holes(kept, height, width)


def supported_components(state: DataFrame, observed: DataFrame, *, least: int = 1, connectivity: int = 8) -> DataFrame:
    """(label, area, observed) of all components but the largest that hold at least `least` observed cells."""
    cells = components(state.select(*CELL), connectivity)
    counts = cells.join(observed.select(*CELL).distinct().withColumn("seen", F.lit(1)), CELL, "left").groupBy("label").agg(F.count("*").alias("area"), F.count("seen").alias("observed"))
    main = counts.orderBy(F.desc("area"), "label").limit(1).select("label")
    return counts.join(F.broadcast(main), "label", "left_anti").filter(F.col("observed") >= least)


def enclosed_islands(land: DataFrame, mainland: DataFrame, height: int, width: int, *, reach: float) -> DataFrame:
    """(label) of land components off the mainland, off the frame, within `reach` of it, and west of its western edge at their rows."""
    cells = components(land.join(mainland.select(*CELL), CELL, "left_anti").select(*CELL), 4)
    stats = centroids(cells).filter(~touches(height, width))
    near = distance_to(cells.join(stats.select("label"), "label", "left_semi"), mainland).groupBy("label").agg(F.min("d2").alias("d2")).filter(F.col("d2") <= reach * reach)
    pad = max(2, round(0.01 * height))
    rows = stats.join(near, "label").select("label", "cx", F.explode(F.sequence(F.greatest(F.lit(0), F.col("top") - pad), F.least(F.lit(height - 1), F.col("bottom") + pad))).alias("y"))
    edge = rows.join(mainland.select("y", "x"), "y").groupBy("label", "cx").agg(F.percentile("x", F.lit(0.02)).alias("edge"))
    return edge.filter(F.col("cx") <= F.col("edge") + max(2.0, 0.006 * width)).select("label")


def within(cells: DataFrame, mask: DataFrame, reach: float) -> DataFrame:
    """The cells within `reach` of the mask: a cell's square of side `reach` meets the mask's cells in it and in the eight around it."""
    side = max(1, math.ceil(reach))
    square = lambda c, k=0: F.floor(F.col(c) / side) + k
    near = mask.select(F.col("y").alias("ky"), F.col("x").alias("kx"))
    for c in "yx":
        near = near.withColumn(f"b{c}", F.explode(F.sequence(square(f"k{c}", -1), square(f"k{c}", 1))))
    d2 = (F.col("y") - F.col("ky")) * (F.col("y") - F.col("ky")) + (F.col("x") - F.col("kx")) * (F.col("x") - F.col("kx"))
    there = (F.col("cy") == F.col("by")) & (F.col("cx") == F.col("bx")) & (d2 <= reach * reach)
    return cells.select(*CELL, square("y").alias("cy"), square("x").alias("cx")).join(dealt(near), there, "left_semi").select(*CELL)


def exterior(line: DataFrame, height: int, width: int, grid: DataFrame | None = None) -> DataFrame:
    """Cells off a line that reach the frame by steps to the four sides; a picture with gaps has only the cells of `grid`."""
    if grid is None:
        grid = line.sparkSession.range(height).select(F.col("id").cast("int").alias("y"), F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("x"))
    else:
        grid = grid.select(*CELL).distinct()
    return shaped(grid.join(dealt(line.select(*CELL)), CELL, "left_anti"), touches(height, width), 4).select(*CELL)


def snapped_water(seed: DataFrame, eligible: DataFrame, line: DataFrame, height: int, width: int, *, reach: float = 40.0, grid: DataFrame | None = None) -> DataFrame:
    """Eligible cells outside a shoreline and within `reach` of a named water's cells; steps go over `grid`, else over the whole frame."""
    open_side = exterior(line, height, width, grid).join(dealt(eligible.select(*CELL)), CELL, "left_semi")
    return within(open_side, seed, reach)


def constrained_water(seed: DataFrame, interior: DataFrame, coverage: DataFrame, *, reach: float, least: float) -> DataFrame:
    """Interior cells covered by water to a share and within `reach` of a named water's cells."""
    wet = interior.select(*CELL).join(coverage.filter(F.col("share") >= least).select(*CELL), CELL)
    return distance_to(wet, seed).filter(F.col("d2") <= reach * reach).select(*CELL)


def evidence_split(cells: DataFrame, *, before: str, interior: str, water: str) -> DataFrame:
    """Adds observed, retained and removed: what a candidate mask did to cells with direct evidence."""
    observed = (F.col(interior) | F.col(water)) & (F.col(before) > 0)
    return cells.withColumns({"observed": observed, "retained": observed & F.col(interior), "removed": observed & ~F.col(interior)})


def restored_evidence(cells: DataFrame, *, interior: str, water: str, value: str) -> DataFrame:
    """Cells with a directly observed class under removed water go back to the interior; adds `restored`."""
    back = F.col(water) & (F.col(value) > 0)
    return cells.withColumns({"restored": back, interior: F.col(interior) | back, water: F.col(water) & ~back})


def chroma_compatible(a: Column, b: Column, centre: tuple[float, float], *, neutral: float, share: float, cosine: float) -> Column:
    """Whether a cell's chroma (a, b around 0) can belong to a class of chroma `centre`; neutral classes take all."""
    size = (centre[0] ** 2 + centre[1] ** 2) ** 0.5
    if size < neutral:
        return F.lit(True)
    own = F.sqrt(a * a + b * b)
    return (own >= size * share) & ((a * centre[0] + b * centre[1]) / F.greatest(own * size, F.lit(1e-6)) >= cosine)


def source_coverage(x: Column, y: Column, width: int, height: int) -> Column:
    """Whether a mapped place is a number and lies in the source picture."""
    return ~F.isnan(x) & ~F.isnan(y) & (x >= 0) & (x <= width - 1) & (y >= 0) & (y <= height - 1)


def hybrid_rows(mainland: DataFrame, first: int, last: int, *, share: float = 0.62) -> DataFrame:
    """(y, divider): in each row the column, at a share of the mainland's span, west of which another source decides."""
    rows = mainland.filter(F.col("y").between(first, last - 1)).groupBy("y").agg(F.min("x").alias("l"), F.max("x").alias("r"))
    return rows.select("y", F.bround(F.col("l") + share * (F.col("r") - F.col("l"))).cast("int").alias("divider"))


def hybrid_interior(mainland: DataFrame, county: DataFrame, first: int, last: int) -> DataFrame:
    """The county's cells up to the divider of a row, the mainland's beyond it and in rows without one."""
    cut = hybrid_rows(mainland, first, last)
    west = county.select(*CELL).join(cut, "y").filter("x <= divider").select(*CELL)
    east = mainland.select(*CELL).join(cut, "y", "left").filter("divider is null or x > divider").select(*CELL)
    return west.unionByName(east)


def composite(overlays: DataFrame) -> DataFrame:
    """The mean colour of the overlays present at each cell, rounded half to even."""
    return overlays.groupBy(*CELL).agg(*[F.rint(F.avg(c)).cast("int").alias(c) for c in "rgb"])
