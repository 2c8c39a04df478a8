"""Choice of controls, candidates and labels for alignments and legends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coordinates import smoothstep


def coast_controls(rows: DataFrame, *, count: int, reach: int, low: float, high: float) -> DataFrame:
    """(y, x, measured, shift): the rows (y, x, gap) nearest to `count` even places, each once, with the median gap around them cut to a leftward shift from `low` to `high`.

    Rows are dealt by blocks of `reach`, so no task holds all of them.
    """
    if count < 3:
        raise ValueError("at least three controls are needed")
    if low <= 0 or high < low:
        raise ValueError("the limits of the shift are not in order")
    span = rows.agg(F.min("y").alias("y0"), F.max("y").alias("y1"))
    wanted = span.select(F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("k"), "y0", "y1").select("k", (F.col("y0") + (F.col("y1") - F.col("y0")) * F.col("k") / F.lit(count - 1)).alias("at"))
    # As many rows as controls: a broadcast of bounded size.
    near = rows.crossJoin(F.broadcast(wanted)).groupBy("k").agg(F.min(F.struct(F.abs(F.col("y") - F.col("at")).alias("d"), "y", "x")).alias("n"))
    chosen = near.groupBy("n.y").agg(F.min("n.x").alias("x"))
    around = rows.select(F.col("y").alias("ry"), "gap", F.explode(F.sequence(F.floor((F.col("y") - reach) / reach), F.floor((F.col("y") + reach) / reach))).alias("block"))
    local = chosen.withColumn("block", F.floor(F.col("y") / reach)).join(around, "block").filter(F.abs(F.col("ry") - F.col("y")) <= reach)
    out = local.groupBy("y", "x").agg(F.percentile("gap", F.lit(0.5)).alias("measured"))
    return out.withColumn("shift", F.greatest(F.lit(-high), F.least(F.lit(-low), F.col("measured"))))


def operation_weight(x: Column, y: Column, *, start: tuple[float, float], ramp: tuple[float, float]) -> Column:
    """How much of a corner operation acts at a place."""
    return smoothstep((x - start[0]) / ramp[0]) * smoothstep((y - start[1]) / ramp[1])


def amplitude(shifts: DataFrame, weight: Column, *, least_weight: float = 0.40, least: int = 9) -> DataFrame:
    """One row: number, median, deviation and whole amplitude of -shift / weight over accepted windows; fewer than `least` raise."""
    values = shifts.filter("accepted").withColumn("_w", weight).filter(F.col("_w") >= least_weight).select((-F.col("shift") / F.col("_w")).alias("v"))
    middle = values.agg(F.count("*").alias("n"), F.percentile("v", F.lit(0.5)).alias("median"))
    off = values.crossJoin(F.broadcast(middle)).agg(F.first("n").alias("n"), F.first("median").alias("median"), F.percentile(F.abs(F.col("v") - F.col("median")), F.lit(0.5)).alias("mad"))
    checked = F.when(F.coalesce(F.col("n"), F.lit(0)) < least, F.raise_error(F.lit("too little evidence for an amplitude")).cast("int")).otherwise(F.floor(F.col("median") + 0.5).cast("int"))
    return off.select("n", "median", "mad", checked.alias("amplitude"))


def paired(halves: DataFrame, key: str, *, apart: float = 2.0) -> DataFrame:
    """Segments of which both halves (half: fit, holdout) were accepted with shifts that agree."""
    one = lambda name: halves.filter(F.col("half") == name).select(key, F.col("shift").alias(name), F.col("accepted").alias(f"{name}_passed"))
    both = one("fit").join(one("holdout"), key).withColumn("difference", F.abs(F.col("fit") - F.col("holdout")))
    return both.withColumn("accepted", F.col("fit_passed") & F.col("holdout_passed") & (F.col("difference") <= apart))


def scale_modes(candidates: DataFrame, *, order: list[str], scale: str, apart: float = 0.35, modes: int = 2) -> list[dict]:
    """The best candidates whose scales differ by `apart` in logarithm from all better ones kept; others than `modes` of them raise.

    Each turn asks for the best row that is far from those kept, so the driver holds `modes` rows.
    """
    kept: list[dict] = []
    while len(kept) < modes:
        far = candidates
        for row in kept:
            far = far.filter(F.abs(F.log(F.col(scale) / F.lit(float(row[scale])))) >= apart)
        best = far.orderBy(*order).first()
        if best is None:
            raise ValueError(f"fewer than {modes} distinct scales")
        kept.append(best.asDict())
    return kept


def label_candidates(rows: DataFrame, by: list[str], *, order: list[Column], label: str = "label", method: str = "method", confidence: str = "confidence", page: str = "full-page-row-association") -> DataFrame:
    """The best reading of each label: no blank or source line, whole-page readings only if nearly as long as the longest, confidence within 10 of the best, then `order`."""
    said = rows.filter((F.trim(label) != "") & ~F.lower(label).startswith("source")).withColumn("_n", F.length(F.regexp_replace(label, r"[^\p{L}\p{N}]", ""))).filter("_n > 0")
    most = said.groupBy(*by).agg(F.max("_n").alias("_most"))
    long = said.join(most, by).filter((F.col(method) != page) | (F.col("_n") >= F.ceil(F.col("_most") * 0.8)))
    sure = long.groupBy(*by).agg(F.max(confidence).alias("_sure"))
    near = long.join(sure, by).filter(F.col(confidence) >= F.col("_sure") - 10.0)
    keys = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    return near.groupBy(*by).agg(F.max_by(F.struct(label, method, confidence), keys).alias("b")).select(*by, "b.*")


def anchor_matches(scores: DataFrame, key: str, *, apart: float, least_support: float, most_median: float, margin: float = 0.0) -> DataFrame:
    """Best shift (dx, dy, score, support, median) of each anchor, the best at least `apart` from it, and acceptance."""
    best = scores.groupBy(key).agg(F.min(F.struct("score", "dy", "dx", "support", "median")).alias("b"))
    d2 = (F.col("dx") - F.col("b.dx")) * (F.col("dx") - F.col("b.dx")) + (F.col("dy") - F.col("b.dy")) * (F.col("dy") - F.col("b.dy"))
    second = scores.join(best, key).filter(d2 >= apart * apart).groupBy(key).agg(F.min("score").alias("runner_up"))
    out = best.join(second, key, "left").select(key, "b.dx", "b.dy", "b.score", "b.support", "b.median", "runner_up")
    unique = F.coalesce(F.col("runner_up") - F.col("score") >= margin, F.lit(True))
    return out.withColumn("accepted", (F.col("support") >= least_support) & (F.col("median") <= most_median) & unique)


def shortlist(fits: DataFrame, by: list[str], score: str, k: int) -> DataFrame:
    """The k lowest scores of each group."""
    return fits.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(score))).filter(F.col("rank") <= k)


def farthest(points: DataFrame, key: str, k: int, quality: str, weight: float) -> list[dict]:
    """k points chosen one after another, each the largest of its least distance to those chosen plus weight x quality; the first is the best of quality.

    The driver holds the chosen points; the table is read once a choice.
    """
    chosen: list[dict] = []
    for _ in range(k):
        if not chosen:
            worth = F.col(quality).cast("double")
        else:
            apart = [F.sqrt((F.col("x") - c["x"]) * (F.col("x") - c["x"]) + (F.col("y") - c["y"]) * (F.col("y") - c["y"])) for c in chosen]
            worth = (F.least(*apart) if len(apart) > 1 else apart[0]) + weight * F.col(quality)
        left = points.filter(~F.col(key).isin([c[key] for c in chosen])) if chosen else points
        row = left.select("*", worth.alias("_worth")).orderBy(F.desc("_worth"), key).first()
        if row is None:
            break
        chosen.append({n: v for n, v in row.asDict().items() if n != "_worth"})
    return chosen


def text_rows(words: DataFrame, by: str, *, gap: int) -> DataFrame:
    """Words (left, right, line) of a line up to the first gap of more than `gap`."""
    order = Window.partitionBy(by, "line").orderBy("left")
    broken = F.col("left") - F.lag("right").over(order) > gap
    told = words.withColumn("_broken", F.coalesce(broken, F.lit(False)).cast("int")).withColumn("_parts", F.sum("_broken").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return told.filter("_parts = 0").drop("_broken", "_parts")
