"""Ordered operators: envelopes, smoothing, splits, ranks, replays of logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_envelope(mask: DataFrame) -> DataFrame:
    """First and last column of each row."""
    return mask.groupBy("y").agg(F.min("x").alias("first_x"), F.max("x").alias("last_x"))


def west_gaps(source: DataFrame, target: DataFrame, *, limit: float) -> DataFrame:
    """Rows that both masks have: target's first column less the source's, both left of `limit`."""
    a, b = row_envelope(source).select("y", F.col("first_x").alias("sx")), row_envelope(target).select("y", F.col("first_x").alias("tx"))
    return a.join(b, "y").filter((F.col("sx") < limit) & (F.col("tx") < limit)).withColumn("gap", F.col("tx") - F.col("sx"))


def median_smooth(rows: DataFrame, order: str, value: str, reach: int, *, by: list[str] | None = None, low: float | None = None, high: float | None = None) -> DataFrame:
    """Adds `smooth`: the median of the values within `reach` along an order, cut to [low, high]."""
    # One window a map or envelope: give `by` where there are several.
    frame = Window.partitionBy(*(by or [])).orderBy(order).rangeBetween(-reach, reach)
    out = F.percentile(F.col(value), F.lit(0.5)).over(frame)
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return rows.withColumn("smooth", out)


def interpolate(rows: DataFrame, order: str, value: str, *, by: list[str] | None = None) -> DataFrame:
    """Linear values between the nearest known ones before and after; ends stay null."""
    parts = by or []
    past, next_ = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*parts).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(order).alias("o"), F.col(value).alias("v")))
    out = rows.withColumns({"_a": F.last(known, True).over(past), "_b": F.first(known, True).over(next_)})
    line = F.col("_a.v") + (F.col("_b.v") - F.col("_a.v")) * (F.col(order) - F.col("_a.o")) / (F.col("_b.o") - F.col("_a.o"))
    return out.withColumn(value, F.when(F.col("_a.o") == F.col("_b.o"), F.col("_a.v").cast("double")).otherwise(line)).drop("_a", "_b")


def balanced_split(cells: DataFrame, by: list[str], order: list[str], *, least: int = 4) -> DataFrame:
    """Alternate rows of each group train and are held out; groups below `least` are left out."""
    w = Window.partitionBy(*by).orderBy(*order)
    n = F.count("*").over(Window.partitionBy(*by))
    return cells.withColumns({"_n": n, "_at": F.row_number().over(w)}).filter(F.col("_n") >= least).withColumn("held_out", F.col("_at") % 2 == 0).drop("_n", "_at")


def best_shift(scores: DataFrame, key: str, shift: str, strength: str) -> DataFrame:
    """The shift with the largest median strength, the earliest of equals."""
    medians = scores.groupBy(key, shift).agg(F.percentile(strength, F.lit(0.5)).alias("m"))
    return medians.groupBy(key).agg(F.max(F.struct("m", (-F.col(shift)).alias("s"))).alias("b")).select(key, (-F.col("b.s")).alias(shift), F.col("b.m").alias(strength))


def top(rows: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; limits are pushed below the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def best_candidate(rows: DataFrame, by: list[str], keys: list[Column], pick: list[str]) -> DataFrame:
    """The lexicographically largest row of each group; rows with a missing key are skipped."""
    whole = rows
    for k in keys:
        whole = whole.filter(k.isNotNull())
    order = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    return whole.groupBy(*by).agg(F.max_by(F.struct(*pick), order).alias("b")).select(*by, "b.*")


def first_condition(conditions: list[Column]) -> Column:
    """1-based number of the first condition that holds; one more where none does."""
    out = F.when(conditions[0], 1)
    for k, c in enumerate(conditions[1:], 2):
        out = out.when(c, k)
    return out.otherwise(len(conditions) + 1)


def regular_runs(rows: DataFrame, by: str, order: str, size: str, run: int = 6, worst: float = 0.18) -> DataFrame:
    """Windows of `run` rows whose sizes and gaps vary least; the earliest of equals."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(0, run - 1)
    step = rows.withColumn("_gap", F.lead(order).over(Window.partitionBy(by).orderBy(order)) - F.col(order))
    inner = Window.partitionBy(by).orderBy(order).rowsBetween(0, run - 2)
    found = step.withColumns({"_n": F.count("*").over(w), "_cv_size": F.stddev_pop(size).over(w) / F.avg(size).over(w), "_cv_gap": F.stddev_pop("_gap").over(inner) / F.avg("_gap").over(inner)})
    good = found.filter((F.col("_n") == run) & (F.col("_cv_size") <= worst) & (F.col("_cv_gap") <= worst)).withColumn("score", F.round(F.col("_cv_size") + F.col("_cv_gap"), 9))
    return good.groupBy(by).agg(F.min(F.struct("score", order)).alias("b")).select(by, F.col(f"b.{order}").alias(order), F.col("b.score").alias("score"))


def ordinals(attempts: DataFrame, by: str, order: str, eligible: str, gates: str) -> DataFrame:
    """Running number of eligible attempts, whether all gates of one pass, and whether it is accepted."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    number = F.sum(F.col(eligible).cast("int")).over(w)
    ok = F.forall(F.map_values(gates), lambda g: g)
    return attempts.withColumns({"ordinal": F.when(F.col(eligible), number), "all_gates": ok, "accepted": F.col(eligible) & ok})


def consensus(words: DataFrame, *, page: str, reach: float, turn: float) -> DataFrame:
    """Distinct angles at which a nearby word of like direction was found, for each word (id, x, y, angle, direction)."""
    square = lambda c, k: (F.floor(F.col(c) / reach) + k)
    a = words.select(page, F.col("id"), "x", "y", F.col("direction"), F.explode(F.sequence(square("x", -1), square("x", 1))).alias("bx"), square("y", 0).alias("cy")).withColumn("by", F.explode(F.sequence(F.col("cy") - 1, F.col("cy") + 1)))
    b = words.select(page, F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("angle"), F.col("direction").alias("od"), square("x", 0).alias("bx"), square("y", 0).alias("by"))
    d = F.pmod(F.col("direction") - F.col("od"), F.lit(180.0))
    near = a.join(b, [page, "bx", "by"]).filter(((F.col("x") - F.col("ox")) * (F.col("x") - F.col("ox")) + (F.col("y") - F.col("oy")) * (F.col("y") - F.col("oy")) <= reach * reach) & (F.least(d, 180 - d) <= turn))
    return near.groupBy(page, "id").agg(F.count_distinct("angle").alias("angles"))


def chain(links: DataFrame, start: str, limit: int = 1000) -> DataFrame:
    """Parents of an artifact in order (step, sha), until none is left; a cycle raises, and so do more than `limit` parents."""
    links.createOrReplaceTempView("terrazzo_links")
    spark = links.sparkSession
    return spark.sql(
        f"""WITH RECURSIVE up(step, sha, path) MAX RECURSION LEVEL {limit + 2} AS (
        SELECT 0, CAST(:start AS string), array(CAST(:start AS string))
        UNION ALL SELECT u.step + 1, l.parent, concat(u.path, array(l.parent)) FROM up u JOIN terrazzo_links l ON l.sha = u.sha WHERE l.parent IS NOT NULL
        AND CASE WHEN array_contains(u.path, l.parent) THEN raise_error('cycle in parents') WHEN u.step >= {limit} THEN raise_error('more than {limit} parents') ELSE true END)
        SELECT step, sha FROM up""",
        args={"start": start},
    )
