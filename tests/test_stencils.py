"""Stencils and polygons against numpy."""

import numpy as np
from pyspark.sql import functions as F

from terrazzo.operators import polygons, stencils
from terrazzo.sources import rasters

RNG = np.random.default_rng(1)


def cells(df):
    return {(r["y"], r["x"]) for r in df.collect()}


def test_box_moments_mirror_borders(spark):
    a = RNG.integers(0, 250, (7, 9))
    df = rasters.from_rows(spark, a.tolist(), "v")
    for mode, edge in (("reflect", False), ("symmetric", True)):
        p = np.pad(a, 2, mode=mode).astype(float)
        w = np.lib.stride_tricks.sliding_window_view(p, (5, 5)).reshape(7, 9, 25)
        for r in stencils.box_moments(df, ["v"], 2, 7, 9, edge=edge).collect():
            assert abs(r["v_mean"] - w[r["y"], r["x"]].mean()) < 1e-9 and abs(r["v_std"] - w[r["y"], r["x"]].std()) < 1e-6


def test_morphology(spark):
    a = RNG.random((12, 12)) < 0.75
    df = rasters.from_rows(spark, [[1 if v else None for v in row] for row in a.tolist()])
    p = np.pad(a, 1)
    w = np.lib.stride_tricks.sliding_window_view(p, (3, 3)).reshape(12, 12, 9)
    assert cells(stencils.eroded(df, 1)) == set(zip(*np.nonzero(w.all(2)), strict=True))
    inside = lambda s: {c for c in s if 0 <= c[0] < 12 and 0 <= c[1] < 12}
    assert inside(cells(stencils.dilated(df, 1))) == set(zip(*np.nonzero(w.any(2)), strict=True))
    assert cells(stencils.opened(df, 1)) <= cells(df) <= cells(stencils.closed(df, 1))


def test_black_hat_marks_a_thin_line(spark):
    grid = [[200] * 9 for _ in range(9)]
    for y in range(9):
        grid[y][4] = 40
    out = stencils.black_hat(rasters.from_rows(spark, grid, "grey"), "grey", 2)
    assert {r["x"] for r in out.filter(F.col("black_hat") >= 20).collect()} == {4}


def test_pure_windows(spark):
    grid = [[1] * 4 + [2] * 4 for _ in range(5)]
    assert cells(stencils.pure(rasters.from_rows(spark, grid), "class_id", 1)) == {(y, x) for y in range(1, 4) for x in (1, 2, 5, 6)}


def test_polygon_with_a_hole(spark):
    ring = lambda n, pts: [("p", n, i, float(x), float(y)) for i, (x, y) in enumerate(pts)]
    rows = ring(0, [(1, 1), (9, 1), (9, 7), (1, 7)]) + ring(1, [(3, 3), (3, 5), (6, 5), (6, 3)])
    df = spark.createDataFrame(rows, "polygon string, ring int, at int, px double, py double")
    got = cells(polygons.rasterise(df, 10, 12))
    assert got == {(y, x) for y in range(1, 7) for x in range(1, 9) if not (3 <= y < 5 and 3 <= x < 6)}
    half = spark.createDataFrame(ring(0, [(0, 0), (1.5, 0), (1.5, 1), (0, 1)]), df.schema)
    assert {(r["y"], r["x"]): r["share"] for r in polygons.coverage(half, 4, 4, 4).collect()} == {(0, 0): 1.0, (0, 1): 0.5}
