"""Least-squares fits from sums: the data stay distributed, a 3 x 3 system reaches the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coordinates import homography
from .audits import residuals

def affine(controls: DataFrame, *, x: str = "x", y: str = "y", u: str = "u", v: str = "v") -> list[list[float]]:
    """The 2 x 3 matrix that takes (x, y) to (u, v); fails below three controls or where they lie on a line."""
    terms = {"x": F.col(x), "y": F.col(y), "1": F.lit(1.0)}
    aggs = [F.sum(terms[a] * terms[b]).alias(f"{a}*{b}") for a in terms for b in terms] + [F.sum(terms[a] * F.col(t)).alias(f"{a}>{n}") for a in terms for t, n in ((u, "u"), (v, "v"))]
    row = controls.agg(*aggs, F.count("*").alias("n")).first()
    if row["n"] < 3:
        raise ValueError("three controls are needed")
    gram = np.array([[row[f"{a}*{b}"] for b in terms] for a in terms], float)
    if np.linalg.matrix_rank(gram) < 3:
        raise ValueError("controls lie on a line")
    return [np.linalg.solve(gram, np.array([row[f"{a}>{n}"] for a in terms], float)).tolist() for n in "uv"]


def affine_residuals(controls: DataFrame, m: list[list[float]], *, x: str = "x", y: str = "y", u: str = "u", v: str = "v") -> DataFrame:
    """Adds the distance of each control from where the matrix takes it."""
    pu, pv = (m[k][0] * F.col(x) + m[k][1] * F.col(y) + m[k][2] for k in (0, 1))
    return controls.withColumn("residual", F.sqrt((pu - F.col(u)) * (pu - F.col(u)) + (pv - F.col(v)) * (pv - F.col(v))))


def translation(controls: DataFrame, by: list[str] | None = None, *, x: str = "x", y: str = "y", u: str = "u", v: str = "v") -> DataFrame:
    """Median shift of each group."""
    return controls.groupBy(*(by or [])).agg(F.percentile(F.col(u) - F.col(x), F.lit(0.5)).alias("du"), F.percentile(F.col(v) - F.col(y), F.lit(0.5)).alias("dv"))


def best_scale(points: DataFrame, candidates: list[float], anchor: float) -> DataFrame:
    """The x-scale about an anchor with the least mean absolute residual against `u`; the first of equals."""
    tried = points.withColumn("scale", F.explode(F.array(*map(F.lit, candidates))))
    cost = tried.groupBy("scale").agg(F.avg(F.abs(anchor + (F.col("x") - anchor) * F.col("scale") - F.col("u"))).alias("cost"))
    return cost.orderBy("cost", "scale").limit(1)


def compact_warp(centres: list[tuple[float, float]], shifts: list[tuple[float, float]], radius: float, ridge: float = 1e-6) -> list[tuple[float, float]]:
    """Coefficients of a sum of compact kernels that meets the shifts at the centres; refuses ill-conditioned systems."""
    c = np.array(centres, float)
    r = np.sqrt(((c[:, None] - c[None]) ** 2).sum(-1)) / radius
    kernel = np.where(r < 1, (1 - r) ** 4 * (4 * r + 1), 0.0) + ridge * np.eye(len(c))
    if np.linalg.cond(kernel) > 1e8:
        raise ValueError("centres are too close for this radius")
    return [tuple(v) for v in np.linalg.solve(kernel, np.array(shifts, float)).tolist()]


def similarity(controls: DataFrame, *, x: str = "x", y: str = "y", u: str = "u", v: str = "v") -> list[list[float]]:
    """The 3 x 3 matrix of a turn, a scale and a shift that takes (x, y) to (u, v); fails below two controls."""
    means = controls.agg(*[F.avg(c).alias(n) for c, n in ((x, "x"), (y, "y"), (u, "u"), (v, "v"))], F.count("*").alias("n")).first()
    if means["n"] < 2:
        raise ValueError("two controls are needed")
    dx, dy, du, dv = (F.col(c) - F.lit(means[n]) for c, n in ((x, "x"), (y, "y"), (u, "u"), (v, "v")))
    s = controls.agg(F.sum(dx * du + dy * dv).alias("a"), F.sum(dx * dv - dy * du).alias("b"), F.sum(dx * dx + dy * dy).alias("q")).first()
    if not s["q"]:
        raise ValueError("controls are one point")
    a, b = s["a"] / s["q"], s["b"] / s["q"]
    return [[a, -b, means["u"] - a * means["x"] + b * means["y"]], [b, a, means["v"] - b * means["x"] - a * means["y"]], [0.0, 0.0, 1.0]]


def projective(controls: DataFrame, *, rounds: int = 8, x: str = "x", y: str = "y", u: str = "u", v: str = "v") -> list[list[float]]:
    """The 3 x 3 matrix with least squared distances after projection: steps of Gauss and Newton from the affine one, each one aggregate of 8 x 8 sums."""
    m = np.array([*affine(controls, x=x, y=y, u=u, v=v), [0.0, 0.0, 1.0]])
    # Places are scaled to their spread, so that the sums of all orders are of one size.
    s = controls.agg(F.avg(x).alias("x"), F.avg(y).alias("y"), F.greatest(F.stddev_pop(x), F.stddev_pop(y)).alias("s"), F.count("*").alias("n")).first()
    if s["n"] < 4:
        raise ValueError("four controls are needed")
    unit = np.array([[1 / s["s"], 0, -s["x"] / s["s"]], [0, 1 / s["s"], -s["y"] / s["s"]], [0, 0, 1]])
    m = m @ np.linalg.inv(unit)
    px, py = (F.col(x) - s["x"]) / s["s"], (F.col(y) - s["y"]) / s["s"]
    for _ in range(rounds):
        row = lambda k, m=m: float(m[k, 0]) * px + float(m[k, 1]) * py + float(m[k, 2])
        w = row(2)
        pu, pv, zero = row(0) / w, row(1) / w, F.lit(0.0)
        by_u = [px / w, py / w, 1 / w, zero, zero, zero, -pu * px / w, -pu * py / w]
        by_v = [zero, zero, zero, px / w, py / w, 1 / w, -pv * px / w, -pv * py / w]
        aggs = [F.sum(by_u[i] * by_u[j] + by_v[i] * by_v[j]).alias(f"g{i}{j}") for i in range(8) for j in range(i, 8)]
        aggs += [F.sum(by_u[i] * (F.col(u) - pu) + by_v[i] * (F.col(v) - pv)).alias(f"r{i}") for i in range(8)]
        sums = controls.agg(*aggs).first()
        gram = np.array([[sums[f"g{min(i, j)}{max(i, j)}"] for j in range(8)] for i in range(8)])
        step = np.linalg.lstsq(gram, np.array([sums[f"r{i}"] for i in range(8)]), rcond=None)[0]
        m = m + np.append(step, 0.0).reshape(3, 3)
        if np.abs(step).max() < 1e-12 * np.abs(m).max():
            break
    m = m @ unit
    return (m / m[2, 2]).tolist()


def moved(m: list[list[float]], x: str = "x", y: str = "y"):
    """Where a 3 x 3 matrix takes a place."""
    return homography(F.col(x), F.col(y), m)


def evaluate(controls: DataFrame, m: list[list[float]], by: list[str] | None = None, *, x: str = "x", y: str = "y", u: str = "u", v: str = "v") -> DataFrame:
    """Residual summary of controls under a 3 x 3 matrix."""
    pu, pv = moved(m, x, y)
    return residuals(controls.withColumn("residual", F.sqrt((pu - F.col(u)) * (pu - F.col(u)) + (pv - F.col(v)) * (pv - F.col(v)))), "residual", by)


def consistent(controls: DataFrame, key: str, *, reach: float = 4.5, tries: int = 200, sample: int = 256, seed: int = 1) -> DataFrame:
    """Controls with `inlier`: within `reach` of the affine fit that most agree with.

    Triples of at most `sample` controls, chosen by hash of the key, propose `tries`
    matrices; all are scored over all controls in one aggregate, and the best (the
    first of equals) is fitted again to its own inliers.
    """
    few = controls.orderBy(F.xxhash64(F.lit(seed), key), key).limit(sample).select("x", "y", "u", "v").collect()
    if len(few) < 4:
        return controls.withColumn("inlier", F.lit(False))
    points = np.array([tuple(r) for r in few], float)
    rng, found = np.random.default_rng(seed), []
    for _ in range(tries):
        p = points[rng.choice(len(points), 3, replace=False)]
        a = np.concatenate([p[:, :2], np.ones((3, 1))], 1)
        if abs(np.linalg.det(a)) > 1e-6:
            found.append(np.linalg.solve(a, p[:, 2:]).T.ravel().tolist())
    apart = lambda m: (m[0] * F.col("x") + m[1] * F.col("y") + m[2] - F.col("u")) ** 2 + (m[3] * F.col("x") + m[4] * F.col("y") + m[5] - F.col("v")) ** 2
    table = controls.sparkSession.createDataFrame(list(enumerate(found)), "k int, m array<double>")
    near = apart([F.col("m")[i] for i in range(6)]) <= reach * reach
    best = controls.crossJoin(F.broadcast(table)).groupBy("k").agg(F.sum(near.cast("int")).alias("n")).orderBy(F.desc("n"), "k").first()
    own = [F.lit(v) for v in found[best["k"]]]
    inside = controls.filter(apart(own) <= reach * reach)
    (a, b, c), (d, e, f) = affine(inside)
    return controls.withColumn("inlier", apart([F.lit(t) for t in (a, b, c, d, e, f)]) <= reach * reach)


def held_out(controls: DataFrame, fold: str) -> DataFrame:
    """Residual summary of each fold under the affine fit to all others: the sums of all folds are taken once, and a fold's are left out of the total."""
    terms = {"x": F.col("x"), "y": F.col("y"), "1": F.lit(1.0)}
    aggs = [F.sum(terms[a] * terms[b]).alias(f"{a}*{b}") for a in terms for b in terms] + [F.sum(terms[a] * F.col(t)).alias(f"{a}>{t}") for a in terms for t in "uv"]
    rows = controls.groupBy(fold).agg(*aggs).collect()  # one row a fold
    gram = {r[fold]: np.array([[r[f"{a}*{b}"] for b in terms] for a in terms], float) for r in rows}
    side = {r[fold]: np.array([[r[f"{a}>{t}"] for t in "uv"] for a in terms], float) for r in rows}
    fitted = []
    for k in gram:
        rest = sum((g for j, g in gram.items() if j != k), np.zeros((3, 3)))
        if np.linalg.matrix_rank(rest) == 3:
            fitted.append((k, np.linalg.solve(rest, sum((s for j, s in side.items() if j != k), np.zeros((3, 2)))).T.ravel().tolist()))
    table = controls.sparkSession.createDataFrame(fitted, f"{fold} {controls.schema[fold].dataType.simpleString()}, m array<double>")
    m = [F.col("m")[i] for i in range(6)]
    off = F.sqrt((m[0] * F.col("x") + m[1] * F.col("y") + m[2] - F.col("u")) ** 2 + (m[3] * F.col("x") + m[4] * F.col("y") + m[5] - F.col("v")) ** 2)
    return residuals(controls.join(F.broadcast(table), fold).withColumn("residual", off), "residual", [fold])


def inverse(m: list[list[float]]) -> list[list[float]]:
    """The matrix back; one that can't be turned round raises."""
    a = np.array(m, float)
    if abs(np.linalg.det(a)) < 1e-12:
        raise ValueError("the matrix has no inverse")
    out = np.linalg.inv(a)
    return (out / out[2, 2]).tolist()
