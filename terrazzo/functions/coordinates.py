"""Coordinates: spherical Mercator, tiles, homographies, local warps."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS = 6378137.0
HALF = math.pi * RADIUS


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * RADIUS, F.log(F.tan(math.pi / 4 + F.radians(lat) / 2)) * RADIUS


def to_wgs84(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / RADIUS), F.degrees(2 * F.atan(F.exp(y / RADIUS)) - math.pi / 2)


def tile_of(lon: Column, lat: Column, zoom: Column) -> tuple[Column, Column]:
    """Tile column and row of a position."""
    n = F.pow(F.lit(2.0), zoom)
    return F.floor((lon + 180.0) / 360.0 * n), F.floor((1.0 - F.asinh(F.tan(F.radians(lat))) / math.pi) / 2.0 * n)


def tile_range(low: Column, high: Column, zoom: Column) -> tuple[Column, Column]:
    """First and last tile along an axis for a Mercator interval; an edge exactly on a tile border adds none."""
    n = F.pow(F.lit(2.0), zoom)
    place = lambda v: (v + HALF) / (2 * HALF) * n
    first = F.floor(place(low) + 1e-9)
    last = F.ceil(place(high) - 1e-9) - 1
    return F.greatest(first, F.lit(0)), F.least(F.greatest(last, first), n.cast("bigint") - 1)


def homography(x: Column, y: Column, m: list[list[float]]) -> tuple[Column, Column]:
    row = lambda r: m[r][0] * x + m[r][1] * y + m[r][2]
    return row(0) / row(2), row(1) / row(2)


def wendland(distance: Column, radius: float) -> Column:
    """(1 - r)^4 (4 r + 1) within the radius, 0 beyond."""
    r = distance / radius
    return F.when(r < 1, F.pow(1 - r, F.lit(4)) * (4 * r + 1)).otherwise(F.lit(0.0))


def smoothstep(t: Column) -> Column:
    c = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return c * c * (3 - 2 * c)


def angle_between(a: Column, b: Column) -> Column:
    """Difference of undirected angles in degrees, 0..90."""
    d = F.pmod(a - b, F.lit(180.0))
    return F.least(d, 180.0 - d)


def corrected(x: Column, y: Column, steps: list[dict]) -> tuple[Column, Column]:
    """Ordered corrections: {"matrix"}, {"smoothstep_x": start, end, shift} or {"centre", "radius", "shift"}."""
    for step in steps:
        if "matrix" in step:
            x, y = homography(x, y, step["matrix"])
        elif "smoothstep_x" in step:
            start, end, shift = step["smoothstep_x"]
            x, y = x + shift * smoothstep((x - start) / (end - start)), y
        else:
            cx, cy = step["centre"]
            w = wendland(F.sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)), step["radius"])
            x, y = x + w * step["shift"][0], y + w * step["shift"][1]
    return x, y


def supersampled_size(width: int, height: int, factor: int) -> tuple[int, int]:
    """A grid that keeps its corners: (n - 1) * factor + 1."""
    return (width - 1) * factor + 1, (height - 1) * factor + 1


def supersampled_matrix(m: list[list[float]], factor: float) -> list[list[float]]:
    """A homography between grids that were both refined by `factor`."""
    d = (factor, factor, 1.0)
    return [[m[i][j] * d[i] / d[j] for j in range(3)] for i in range(3)]
