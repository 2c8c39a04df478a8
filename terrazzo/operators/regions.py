"""Connected components of cells, and the repairs that rest on them.

Cells of one row that touch are one run first, so labels spread over runs and not
over cells: an edge list of runs that touch across rows goes to `graphs.components`,
whose rounds follow the logarithm of a component's extent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import dealt, written
from . import graphs

CELL = ["y", "x"]
#: Half of the neighbours; the other half are the same pairs read backwards.
HALF = {4: [(0, 1), (1, 0)], 8: [(0, 1), (1, 0), (1, 1), (1, -1)]}


def neighbours(cells: DataFrame, connectivity: int = 8, *, same: str | None = None) -> DataFrame:
    """(y, x, ny, nx) of neighbouring pairs, both ways; with `same`, of equal value only."""
    steps = [(dy * s, dx * s) for dy, dx in HALF[connectivity] for s in (1, -1)]
    moves = F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in steps])).alias("m")
    keep = [same] if same else []
    near = cells.select(*CELL, *keep, moves).select(*CELL, *keep, (F.col("y") + F.col("m.dy")).alias("ny"), (F.col("x") + F.col("m.dx")).alias("nx"))
    other = cells.select(F.col("y").alias("ny"), F.col("x").alias("nx"), *[F.col(same).alias("_v")] if same else [])
    out = near.join(other, ["ny", "nx"])
    return (out.filter(F.col(same) == F.col("_v")) if same else out).select(*CELL, "ny", "nx")


def components(cells: DataFrame, connectivity: int = 8, *, same: str | None = None) -> DataFrame:
    """The cells with `label`: one value a component, that of its least cell; with `same`, of cells of equal value."""
    keep = [same] if same else []
    code = lambda y, x: F.col(y).cast("long") * (1 << 31) + F.col(x)
    row = Window.partitionBy("y").orderBy("x")
    goes_on = F.col("x") == F.lag("x").over(row) + 1
    if same:
        goes_on &= F.col(same) == F.lag(same).over(row)
    state = cells.select(*CELL, *keep).withColumn("_start", F.when(F.coalesce(goes_on, F.lit(False)), None).otherwise(code("y", "x")))
    state = written(state.withColumn("id", F.last("_start", True).over(row)).drop("_start"))
    steps = F.explode(F.array(*[F.lit(dx) for dx in ((0,) if connectivity == 4 else (-1, 0, 1))])).alias("dx")
    below = state.select("y", "x", *keep, "id", steps).select((F.col("y") + 1).alias("y"), (F.col("x") + F.col("dx")).alias("x"), *keep, F.col("id").alias("a"))
    edges = written(below.join(dealt(state.select(*CELL, *keep, F.col("id").alias("b"))), [*CELL, *keep]).select("a", "b").distinct())
    found = graphs.components(edges).select(F.col("node").alias("id"), "component")
    return state.join(dealt(found), "id", "left").select(*CELL, *keep, F.coalesce("component", "id").alias("label"))


def component_stats(labelled: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Area and bounding box of each component."""
    return labelled.groupBy("label", *(by or [])).agg(F.count("*").alias("area"), F.min("y").alias("top"), F.max("y").alias("bottom"), F.min("x").alias("left"), F.max("x").alias("right"))


def retain(labelled: DataFrame, *, minimum_area: int, maximum_components: int) -> DataFrame:
    """Cells of the largest components, ties to the lower label."""
    top = component_stats(labelled).filter(F.col("area") >= minimum_area).orderBy(F.desc("area"), "label").limit(maximum_components)
    return labelled.join(F.broadcast(top.select("label")), "label", "left_semi")


def ring(labelled: DataFrame, values: DataFrame, value: str = "class_id", connectivity: int = 8) -> DataFrame:
    """(label, y, x, value): the cells around each component, each once."""
    steps = [(dy * s, dx * s) for dy, dx in HALF[connectivity] for s in (1, -1)]
    moves = F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in steps])).alias("m")
    near = labelled.select("label", *CELL, moves).select("label", (F.col("y") + F.col("m.dy")).alias("y"), (F.col("x") + F.col("m.dx")).alias("x")).distinct()
    outside = near.join(labelled.select("label", *CELL), ["label", *CELL], "left_anti")
    return outside.join(values.select(*CELL, value), CELL, "left")


def fill_enclosed(values: DataFrame, *, limit: int, height: int, width: int, protected: DataFrame | None = None, value: str = "class_id") -> DataFrame:
    """Fills holes of fewer than `limit` no-data cells that touch no edge and border one class only; adds `filled`."""
    holes = components(values.filter(F.col(value) == 0).select(*CELL), 8)
    bad = holes.filter((F.col("y") == 0) | (F.col("x") == 0) | (F.col("y") == height - 1) | (F.col("x") == width - 1)).select("label")
    if protected is not None:
        bad = bad.union(holes.join(protected.select(*CELL), CELL, "left_semi").select("label"))
    around = ring(holes, values, value).groupBy("label").agg(F.min(F.coalesce(value, F.lit(0))).alias("low"), F.max(F.coalesce(value, F.lit(0))).alias("high"))
    good = component_stats(holes).filter(F.col("area") < limit).select("label").join(around.filter("low = high and low > 0"), "label").join(bad.distinct(), "label", "left_anti")
    new = holes.join(good, "label").select(*CELL, F.col("low").alias("_new"))
    return values.join(new, CELL, "left").withColumns({value: F.coalesce("_new", value), "filled": F.col("_new").isNotNull()}).drop("_new")


def suppress_specks(values: DataFrame, *, limit: int, purity: float, exempt: DataFrame | None = None, value: str = "class_id") -> DataFrame:
    """Components of at most `limit` cells take the class that holds `purity` of the other classes around them."""
    parts = components(values.filter(F.col(value) > 0).select(*CELL, value), 8, same=value)
    small = component_stats(parts).filter(F.col("area") <= limit).select("label")
    cells = parts.join(small, "label")
    if exempt is not None:
        cells = cells.join(cells.join(exempt.select(*CELL), CELL, "left_semi").select("label").distinct(), "label", "left_anti")
    own = cells.select("label", F.col(value).alias("own")).distinct()
    around = ring(cells.select("label", *CELL), values, value).join(own, "label").filter((F.col(value) > 0) & (F.col(value) != F.col("own")))
    votes = around.groupBy("label", value).agg(F.count("*").alias("n"))
    major = votes.groupBy("label").agg(F.sum("n").alias("all"), F.max(F.struct("n", (-F.col(value)).alias("k"))).alias("top"))
    new = cells.join(major.filter(F.col("top.n") >= purity * F.col("all")), "label").select(*CELL, (-F.col("top.k")).alias("_new"))
    return values.join(new, CELL, "left").withColumns({value: F.coalesce("_new", value), "suppressed": F.col("_new").isNotNull()}).drop("_new")


def closed_interiors(lines: DataFrame, *, height: int, width: int, grid: DataFrame) -> DataFrame:
    """Cells that four-connected steps from the frame don't reach, lines left out."""
    free = grid.join(lines.select(*CELL), CELL, "left_anti")
    parts = components(free, 4)
    outside = parts.filter((F.col("y") == 0) | (F.col("x") == 0) | (F.col("y") == height - 1) | (F.col("x") == width - 1)).select("label").distinct()
    return parts.join(outside, "label", "left_anti").select(*CELL)
