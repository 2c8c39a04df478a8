"""Stencils as two passes of window frames: along rows, then along columns.

A rectangular sum, minimum or maximum separates by axis, so a frame of 2 r + 1 cells
in a row and one in a column give the same as (2 r + 1)^2 neighbours, at a cost that
follows the number of cells. A window holds one row or column of one map. Borders
are mirrored first where a mean needs them: with the edge (…cb|abc…) or without it
(…dcb|abcd…). Means and grey closings need a row for every cell of the grid
(`dense` adds those that are missing); masks don't.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ["y", "x"]


def mirrored(cells: DataFrame, height: int, width: int, reach: int, *, edge: bool = False) -> DataFrame:
    """The cells and their mirror images up to `reach` beyond the frame; `edge` repeats the border cells."""
    k = 0 if edge else 1

    def along(df: DataFrame, c: str, size: int) -> DataFrame:
        v = F.col(c)
        low, high = -v - (1 if edge else 0), 2 * (size - 1) - v + (1 if edge else 0)
        places = F.array_compact(F.array(v, F.when((v >= k) & (low >= -reach), low), F.when((v <= size - 1 - k) & (high <= size - 1 + reach), high)))
        return df.withColumn(c, F.explode(places))

    return along(along(cells, "y", height), "x", width)


def dense(cells: DataFrame, grid: DataFrame, fill: dict[str, float]) -> DataFrame:
    """Every cell of the grid, with `fill` where a cell has no row."""
    return grid.join(cells, CELL, "left").fillna(fill)


def frames(cells: DataFrame, reach: int, steps: dict[str, tuple[Column, Callable[[Column], Column]]], by: list[str] | None = None) -> DataFrame:
    """Adds a column a step: an aggregate over the square of side 2 reach + 1, done by rows, then by columns."""
    parts = by or []
    rows = Window.partitionBy(*parts, "y").orderBy("x").rangeBetween(-reach, reach)
    columns = Window.partitionBy(*parts, "x").orderBy("y").rangeBetween(-reach, reach)
    first = cells.withColumns({f"_{n}": f(c).over(rows) for n, (c, f) in steps.items()})
    return first.withColumns({n: f(F.col(f"_{n}")).over(columns) for n, (_, f) in steps.items()}).drop(*[f"_{n}" for n in steps])


def box_moments(cells: DataFrame, values: list[str], reach: int, height: int, width: int, *, edge: bool = False, by: list[str] | None = None) -> DataFrame:
    """Adds mean and standard deviation of each value in the square around every cell, borders mirrored."""
    wide = mirrored(cells, height, width, reach, edge=edge)
    steps = {"_n": (F.lit(1), F.sum)}
    for v in values:
        steps |= {f"{v}_s": (F.col(v).cast("double"), F.sum), f"{v}_q": (F.col(v).cast("double") * F.col(v), F.sum)}
    sums = frames(wide, reach, steps, by).filter((F.col("y") >= 0) & (F.col("y") < height) & (F.col("x") >= 0) & (F.col("x") < width))
    out = {}
    for v in values:
        mean = F.col(f"{v}_s") / F.col("_n")
        out |= {f"{v}_mean": mean, f"{v}_std": F.sqrt(F.greatest(F.col(f"{v}_q") / F.col("_n") - mean * mean, F.lit(0.0)))}
    return sums.withColumns(out).drop("_n", *[f"{v}_{k}" for v in values for k in "sq"])


def dilated(mask: DataFrame, reach: int) -> DataFrame:
    """Cells within `reach` of a mask, by the larger of the two distances."""
    near = F.sequence(F.lit(-reach), F.lit(reach))
    rows = mask.select("y", F.explode(F.transform(near, lambda d: F.col("x") + d)).alias("x")).distinct()
    return rows.select(F.explode(F.transform(near, lambda d: F.col("y") + d)).alias("y"), "x").distinct()


def eroded(mask: DataFrame, reach: int) -> DataFrame:
    """Cells whose whole square lies in the mask; what is beyond the frame counts as outside."""
    full = frames(mask.select(*CELL), reach, {"_n": (F.lit(1), F.sum)})
    return full.filter(F.col("_n") == (2 * reach + 1) ** 2).select(*CELL)


def closed(mask: DataFrame, reach: int) -> DataFrame:
    return eroded(dilated(mask, reach), reach)


def opened(mask: DataFrame, reach: int) -> DataFrame:
    return dilated(eroded(mask, reach), reach)


def black_hat(cells: DataFrame, value: str, reach: int, by: list[str] | None = None) -> DataFrame:
    """Adds `black_hat`: the grey closing less the value, large on narrow dark strokes."""
    grown = frames(cells, reach, {"_d": (F.col(value), F.max)}, by)
    shrunk = frames(grown, reach, {"_c": (F.col("_d"), F.min)}, by)
    return shrunk.withColumn("black_hat", F.col("_c") - F.col(value)).drop("_c", "_d")


def pure(cells: DataFrame, value: str, reach: int) -> DataFrame:
    """Cells whose square is complete and of one class."""
    ends = frames(cells, reach, {"_n": (F.lit(1), F.sum), "_low": (F.col(value), F.min), "_high": (F.col(value), F.max)})
    return ends.filter((F.col("_n") == (2 * reach + 1) ** 2) & (F.col("_low") == F.col("_high"))).select(*CELL, value)
