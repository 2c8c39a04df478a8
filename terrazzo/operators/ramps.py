"""Continuous ramps and numeric bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Stop = tuple[float, tuple[float, float, float]]


def project(pixels: DataFrame, columns: list[str], stops: list[Stop], *, weights: tuple[float, float, float] = (1.0, 1.0, 1.0), worst: float | None = None) -> DataFrame:
    """Adds value and residual of the nearest point of a piecewise linear ramp; the first of equal segments counts."""
    stops = sorted(stops)
    options = []
    for k, ((v0, c0), (v1, c1)) in enumerate(zip(stops, stops[1:], strict=False)):
        along = [(b - a) * w for a, b, w in zip(c0, c1, weights, strict=True)]
        size = sum(d * d for d in along)
        off = [(F.col(c) - a) * w for c, a, w in zip(columns, c0, weights, strict=True)]
        dot = sum((o * d for o, d in zip(off, along, strict=True)), F.lit(0.0))
        t = F.least(F.greatest(dot / (size or 1.0), F.lit(0.0)), F.lit(1.0))
        apart = sum(((o - t * d) * (o - t * d) for o, d in zip(off, along, strict=True)), F.lit(0.0))
        options.append(F.struct(apart.alias("d"), F.lit(k).alias("k"), (v0 + t * (v1 - v0)).alias("v")))
    out = pixels.withColumn("_p", F.array_min(F.array(*options)) if len(options) > 1 else options[0])
    residual = F.sqrt(F.col("_p.d"))
    value = F.col("_p.v") if worst is None else F.when(residual <= worst, F.col("_p.v"))
    return out.withColumns({"value": value, "residual": residual}).drop("_p")


def nearest_stop(values: DataFrame, value: str, stops: list[Stop]) -> DataFrame:
    """Adds the colour of the stop nearest to a value; halfway goes up."""
    stops = sorted(stops)
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(value) - v).alias("d"), F.lit(-v).alias("neg"), *[F.lit(int(x)).alias(c) for x, c in zip(rgb, "rgb", strict=True)]) for v, rgb in stops]))
    return values.withColumn("_s", best).withColumns({c: F.col(f"_s.{c}") for c in "rgb"}).drop("_s")


def bands(stops: list[float]) -> list[tuple[float, float]]:
    """Half-open bands between stops, one below the first and one above the last."""
    edges = [float("-inf"), *sorted(stops), float("inf")]
    return list(zip(edges, edges[1:], strict=False))


def band_id(values: DataFrame, value: str, stops: list[float], *, closed_last: bool = False) -> DataFrame:
    """Adds band_id (0 below the first stop): the stops at or below the value; with closed_last the last stop is in the band before."""
    stops = sorted(stops)
    v = F.col(value)
    n = sum(((v >= s).cast("int") for s in stops), F.lit(0))
    if closed_last:
        n = F.when(v == stops[-1], F.lit(len(stops) - 1)).otherwise(n)
    return values.withColumn("band_id", F.when(v.isNotNull(), n))
