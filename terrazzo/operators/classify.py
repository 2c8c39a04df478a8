"""Nearest-prototype classification with distance and margin gates.

Prototypes are plan parameters, a few hundred at most, and become literals of the
expression: no join, no shuffle. Pixels repeat colours, so `by_distinct` classifies
each distinct colour once.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Prototype = tuple[int, tuple[float, ...]]


def squared(columns: list[Column], centre: tuple[float, ...]) -> Column:
    total = F.lit(0.0)
    for c, v in zip(columns, centre, strict=True):
        total = total + (c - F.lit(v)) * (c - F.lit(v))
    return total


def ranked(columns: list[Column], prototypes: list[Prototype]) -> Column:
    """Array of (squared distance, class), the nearest prototype of each class, nearest class first, ties to the lower id."""
    by_class: dict[int, list[Column]] = {}
    for k, centre in prototypes:
        by_class.setdefault(k, []).append(squared(columns, centre))
    best = [F.struct((F.least(*d) if len(d) > 1 else d[0]).alias("d"), F.lit(k).alias("k")) for k, d in sorted(by_class.items())]
    return F.array_sort(F.array(*best))


def classify(pixels: DataFrame, columns: list[str], prototypes: list[Prototype], *, max_distance: float | None = None, min_margin: float | None = None) -> DataFrame:
    """Adds nearest_id, distance, margin and class_id (0 where a gate fails)."""
    out = pixels.withColumn("_r", ranked([F.col(c) for c in columns], prototypes))
    d1, d2 = F.sqrt(F.col("_r")[0]["d"]), F.sqrt(F.get(F.col("_r"), F.lit(1))["d"])
    out = out.withColumns({"nearest_id": F.col("_r")[0]["k"], "distance": d1, "margin": F.coalesce(d2, F.lit(float("inf"))) - d1})
    ok = F.lit(True)
    if max_distance is not None:
        ok = ok & (F.col("distance") <= max_distance)
    if min_margin is not None:
        ok = ok & (F.col("margin") >= min_margin)
    return out.withColumn("class_id", F.when(ok, F.col("nearest_id")).otherwise(F.lit(0))).drop("_r")


def by_distinct(pixels: DataFrame, columns: list[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`step` on the distinct values of `columns`, joined back; worth it where the step costs more than a shuffle."""
    return pixels.join(step(pixels.select(*columns).distinct()), columns)


def vector_distances(vectors: DataFrame, centres: DataFrame, *, key: str, vector: str, label: str, centre: str) -> DataFrame:
    """(key, label, distance) against a table of centres with one row a class."""
    d = F.sqrt(F.aggregate(F.zip_with(vector, centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))
    return vectors.select(key, vector).crossJoin(F.broadcast(centres.select(F.col(label).alias("_label"), F.col(centre)))).select(key, F.col("_label").alias(label), d.alias("distance"))


def class_centres(vectors: DataFrame, *, vector: str, label: str) -> DataFrame:
    """Mean vector of each class, summed by dimension before rows meet."""
    parts = vectors.select(label, F.posexplode(vector).alias("i", "v")).groupBy(label, "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    return parts.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centre"))


def gate(distances: DataFrame, *, key: str, label: str, max_distance: Column, min_margin: Column) -> DataFrame:
    """Nearest class of each key and whether both gates pass, from (key, label, distance) rows."""
    best = distances.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("distance", label))).alias("r"))
    d1, d2 = F.col("r")[0]["distance"], F.get(F.col("r"), F.lit(1))["distance"]
    ok = (d1 <= max_distance) & (F.coalesce(d2, F.lit(float("inf"))) - d1 >= min_margin)
    return best.select(key, d1.alias("d1"), d2.alias("d2"), F.col("r")[0][label].alias("nearest"), ok.alias("accepted"))


def threshold_ensemble(ranked_rows: DataFrame, *, distances: list[float], margins: list[float]) -> DataFrame:
    """Each gated row under every pair of thresholds: whether any, all or the middle setting accepts."""
    ok = [F.when((F.col("d1") <= d) & (F.col("d2") - F.col("d1") >= m), 1).otherwise(0) for d in distances for m in margins]
    total = sum(ok[1:], ok[0])
    return ranked_rows.withColumns({"settings": total, "always": total == len(ok), "never": total == 0, "middle": ok[len(ok) // 2] == 1})


def hue_intervals(pixels: DataFrame, hue: str, intervals: list[tuple[float, float]]) -> DataFrame:
    """Nearest hue interval (1-based) and the distance to it; within one it is 0."""
    options = [F.struct(F.greatest(low - F.col(hue), F.col(hue) - high, F.lit(0.0)).alias("d"), F.lit(k + 1).alias("k")) for k, (low, high) in enumerate(intervals)]
    return pixels.withColumn("_b", F.array_min(F.array(*options))).withColumns({"class_id": F.col("_b.k"), "hue_distance": F.col("_b.d")}).drop("_b")


def unmix(pixels: DataFrame, a: str, b: str, inks: list[tuple[float, float]], *, penalty: float = 0.0, least: float = 0.25, worst: float | None = None, chroma: float = 0.0) -> DataFrame:
    """Best nonnegative mixture of at most two inks in a chroma plane: adds `inks` (ids) and `residual`."""
    x, y = F.col(a), F.col(b)
    options = []
    for k, (u, v) in enumerate(inks):
        t = F.greatest((x * u + y * v) / (u * u + v * v), F.lit(0.0))
        options.append(F.struct((F.sqrt((x - t * u) * (x - t * u) + (y - t * v) * (y - t * v)) + penalty).alias("score"), F.lit(k).alias("rank"), F.array(F.struct(F.lit(k + 1).alias("id"), t.alias("t"))).alias("parts")))
    for n, (i, j) in enumerate(combinations(range(len(inks)), 2)):
        (u, v), (p, q) = inks[i], inks[j]
        det = u * q - p * v
        if abs(det) < 1e-9:
            continue
        s, t = (x * q - y * p) / det, (y * u - x * v) / det
        score = F.when((s >= 0) & (t >= 0), F.lit(2 * penalty)).otherwise(F.lit(float("inf")))
        options.append(F.struct(score.alias("score"), F.lit(len(inks) + n).alias("rank"), F.array(F.struct(F.lit(i + 1).alias("id"), s.alias("t")), F.struct(F.lit(j + 1).alias("id"), t.alias("t"))).alias("parts")))
    best = pixels.withColumn("_m", F.array_min(F.array(*options)))
    ids = F.transform(F.filter(F.col("_m.parts"), lambda e: e["t"] >= least), lambda e: e["id"])
    ok = F.sqrt(x * x + y * y) >= chroma
    if worst is not None:
        ok = ok & (F.col("_m.score") <= worst)
    return best.withColumns({"inks": F.when(ok, ids).otherwise(F.expr("cast(array() as array<int>)")), "residual": F.col("_m.score")}).drop("_m")


def colour_distribution(pixels: DataFrame, group: list[str], colour: str, top: int = 16) -> DataFrame:
    """The most frequent colours of each group as shares, ties to the lower colour."""
    counts = pixels.groupBy(*group, colour).agg(F.count("*").alias("n"))
    listed = counts.groupBy(*group).agg(F.sum("n").alias("total"), F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col(colour).alias("c")))), 1, top).alias("top"))
    return listed.select(*group, "total", F.posexplode("top").alias("rank", "e")).select(*group, F.col("e.c").alias(colour), F.col("rank"), (-F.col("e.m") / F.col("total")).alias("share"))
