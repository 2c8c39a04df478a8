"""Agreement of line masks: distances both ways, tails by cell, consistency of matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .audits import count_if, residuals
from .masks import distance_to
from .regions import CELL

FAR = 1e6


def line_report(rendered: DataFrame, source: DataFrame, scope: DataFrame | None = None, *, tolerance: float, scale: float = 1.0) -> DataFrame:
    """One row: distances of rendered to source cells, in working pixels, and precision, recall and F1 within `tolerance`.

    An empty side gives 1e6 for its distances and 0 for its shares.
    """
    back = source.join(scope.select(*CELL), CELL, "left_semi") if scope is not None else source
    d = F.sqrt("d2") * scale
    there = distance_to(rendered, source).select(d.alias("d"))
    forward = there.agg(F.count("*").alias("n"), F.percentile("d", F.lit(0.5)).alias("median"), F.percentile("d", F.lit(0.9)).alias("p90"), F.avg((F.col("d") <= 5).cast("double")).alias("within_5"), F.avg((F.col("d") <= 8).cast("double")).alias("within_8"), F.avg((F.col("d") <= tolerance).cast("double")).alias("precision"))
    reverse = distance_to(back, rendered).select(d.alias("d")).agg(F.count("*").alias("n_source"), F.avg((F.col("d") <= tolerance).cast("double")).alias("recall"))
    one = forward.crossJoin(reverse)  # one row each
    out = one.select("n", "n_source", *[F.coalesce(c, F.lit(FAR)).alias(c) for c in ("median", "p90")], *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("within_5", "within_8", "precision", "recall")])
    return out.withColumn("f1", 2 * F.col("precision") * F.col("recall") / F.greatest(F.col("precision") + F.col("recall"), F.lit(1e-12)))


def balanced_tail(points: DataFrame, distance: str, *, height: int, width: int, rows: int, columns: int, least: int = 20, limit: float = 12.0) -> DataFrame:
    """(row, col, n, median, p90, passed) of grid cells with at least `least` points (y, x, distance)."""
    at = lambda c, size, k: F.floor(F.col(c) * k / F.lit(size)).cast("int")
    cells = points.groupBy(at("y", height, rows).alias("row"), at("x", width, columns).alias("col"))
    out = cells.agg(F.count("*").alias("n"), F.percentile(distance, F.lit(0.5)).alias("median"), F.percentile(distance, F.lit(0.9)).alias("p90"), F.avg((F.col(distance) <= 8).cast("double")).alias("within_8"))
    return out.filter(F.col("n") >= least).withColumn("passed", F.col("p90") <= limit)


def corridor_agreement(one: DataFrame, other: DataFrame, reach: int = 2) -> DataFrame:
    """One row: cells of each mask within a square corridor around the other; shares are null where a mask is empty."""
    step = F.sequence(F.lit(-reach), F.lit(reach))

    def corridor(mask: DataFrame) -> DataFrame:
        grown = mask.select(*CELL, F.explode(step).alias("dy")).withColumn("dx", F.explode(step))
        return grown.select((F.col("y") + F.col("dy")).alias("y"), (F.col("x") + F.col("dx")).alias("x")).distinct().withColumn("near", F.lit(1))

    def counted(mask: DataFrame, near: DataFrame, name: str) -> DataFrame:
        return mask.select(*CELL).distinct().join(corridor(near), CELL, "left").agg(F.count("*").alias(name), F.count("near").alias(f"{name}_supported"))

    both = counted(one, other, "one").crossJoin(counted(other, one, "other"))  # one row each
    return both.withColumns({f"{n}_share": F.try_divide(F.col(f"{n}_supported"), F.col(n)) for n in ("one", "other")})


def separation(assigned: DataFrame, held_out: DataFrame, excluded: DataFrame, *, least: float = 24.0) -> DataFrame:
    """One row: assigned cells, those in the exclusion, the least distance to held-out cells, and whether both are as required."""
    overlap = assigned.join(excluded.select(*CELL), CELL, "left_semi").agg(F.count("*").alias("overlap"))
    near = distance_to(assigned, held_out).agg(F.count("*").alias("n"), F.sqrt(F.min("d2")).alias("separation"))
    return near.crossJoin(overlap).withColumn("passed", (F.col("overlap") == 0) & (F.col("n") > 0) & (F.col("separation") >= least))


def match_consistency(matches: DataFrame, *, side: float, least: int, most: float, outlier: float = 3.0) -> DataFrame:
    """Bins (row, col) of eligible matches (y, x, dx, dy): robust support, median residual, deviation, and acceptance.

    Matches farther from a bin's median than `outlier` median deviations (1 at least) are left out.
    """
    at = [F.floor(F.col("y") / side).cast("int").alias("row"), F.floor(F.col("x") / side).cast("int").alias("col")]
    rows = matches.filter("eligible").select(*at, "dx", "dy")
    middle = lambda d, n: d.groupBy("row", "col").agg(F.count("*").alias(n), F.percentile("dx", F.lit(0.5)).alias("mx"), F.percentile("dy", F.lit(0.5)).alias("my"))
    off = F.sqrt((F.col("dx") - F.col("mx")) * (F.col("dx") - F.col("mx")) + (F.col("dy") - F.col("my")) * (F.col("dy") - F.col("my")))
    told = rows.join(middle(rows, "support"), ["row", "col"]).withColumn("off", off)
    spread = told.groupBy("row", "col").agg(F.percentile("off", F.lit(0.5)).alias("mad"))
    good = told.join(spread, ["row", "col"]).filter(F.col("off") <= outlier * F.greatest("mad", F.lit(1.0))).select("row", "col", "dx", "dy", "support")
    again = good.join(middle(good, "robust"), ["row", "col"]).withColumn("off", off)
    out = again.groupBy("row", "col", "support", "robust", "mx", "my").agg(F.percentile("off", F.lit(0.5)).alias("mad"))
    return out.withColumn("accepted", (F.col("robust") >= least) & (F.col("mad") <= most))


def profile_summary(profiles: DataFrame, shift: str, accepted: str, *, by: list[str] | None = None) -> DataFrame:
    """Residual summaries of absolute shifts over all windows and over the accepted ones (`set`), and the signed median."""
    both = profiles.select(*(by or []), F.abs(shift).alias("v"), F.col(shift).alias("signed"), F.explode(F.when(F.col(accepted), F.array(F.lit("all"), F.lit("accepted"))).otherwise(F.array(F.lit("all")))).alias("set"))
    keys = [*(by or []), "set"]
    return residuals(both, "v", keys).join(both.groupBy(*keys).agg(F.percentile("signed", F.lit(0.5)).alias("signed_median")), keys)


def patch_score(samples: DataFrame, by: list[str], *, points: str, distance: str, valid: str, shift: Column, least: int, weight: float, direction: str | None = None) -> DataFrame:
    """Score of each shifted patch from its samples: near, well supported, small shifts win; 1e6 where too few are valid."""
    ok = samples.filter(F.col(valid))
    d = F.col(distance)
    aggs = [F.count("*").alias("used"), F.avg(F.least(d, F.lit(12.0))).alias("mean"), F.percentile(d, F.lit(0.5)).alias("median"), F.percentile(d, F.lit(0.9)).alias("p90"), F.avg((d <= 2.5).cast("double")).alias("support")]
    if direction:
        aggs.append(F.percentile(direction, F.lit(0.5)).alias("agreement"))
    told = samples.groupBy(*by).agg(F.max(points).alias("points"), F.max(shift).alias("shift")).join(ok.groupBy(*by).agg(*aggs), by, "left")
    enough = F.coalesce(F.col("used"), F.lit(0)) >= F.greatest(F.lit(least), F.floor(F.col("points") / 2))
    score = F.col("mean") + 0.2 * F.least("p90", F.lit(12.0)) - 1.75 * F.col("support") + weight * F.col("shift")
    if direction:
        score += 1.25 * (1 - F.col("agreement"))
    return told.select(*by, F.when(enough, score).otherwise(F.lit(FAR)).alias("score"), (F.coalesce("used", F.lit(0)) / F.col("points")).alias("valid_share"), F.when(enough, F.col("support")).otherwise(F.lit(0.0)).alias("support"), F.when(enough, F.col("median")).otherwise(F.lit(FAR)).alias("median"), F.when(enough, F.col("p90")).otherwise(F.lit(FAR)).alias("p90"))


def zero_shift(scores: DataFrame, *, least: float, accepted: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Residual summary of the patch medians at no shift, of visible and, if given, accepted patches."""
    seen = scores if accepted is None else scores.join(accepted.select(key), key, "left_semi")
    return residuals(seen.filter((F.col("valid_share") >= least) & (F.col("median") < 1e5)), "median")


def robust_loss(values: DataFrame, distance: str, inside: str, by: list[str]) -> DataFrame:
    """A candidate's loss: capped mean, capped tail and what falls outside."""
    d = F.col(distance)
    out = values.groupBy(*by).agg(F.avg(F.least(d, F.lit(20.0))).alias("mean"), F.percentile(d, F.lit(0.9)).alias("p90"), F.avg(F.col(inside).cast("double")).alias("visible"))
    return out.withColumn("loss", F.col("mean") + 0.35 * F.least("p90", F.lit(100.0)) + 30.0 * (1.0 - F.col("visible")))


def jacobian(points: DataFrame, mapping) -> DataFrame:
    """One row: least, median, largest determinant of a mapping (x, y) -> (u, v) by unit differences, and folds."""
    x, y = F.col("x"), F.col("y")
    (u, v), (ux, vx), (uy, vy) = mapping(x, y), mapping(x + 1, y), mapping(x, y + 1)
    det = points.select(((ux - u) * (vy - v) - (vx - v) * (uy - u)).alias("d"))
    out = det.agg(F.count("*").alias("n"), F.min("d").alias("least"), F.percentile("d", F.lit(0.5)).alias("median"), F.max("d").alias("largest"), F.avg((F.col("d") > 0).cast("double")).alias("positive"), count_if(F.col("d") <= 0).alias("folds"))
    return out.withColumn("ratio", F.col("least") / F.greatest("median", F.lit(1e-12)))
