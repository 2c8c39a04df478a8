"""Regional audits of layers against their source, and the state of published sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import cell
from .audits import CELL, count_if


def region_window(box: tuple[float, float, float, float], bounds: tuple[float, float, float, float], width: int, height: int) -> tuple[int, int, int, int]:
    """(left, top, right, bottom) of a box (x0, y0, x1, y1) in the raster's projection, cut to it; a box beside it raises."""
    x0, y0, x1, y1 = box
    low_x, low_y, high_x, high_y = bounds
    if not (x0 < x1 and y0 < y1):
        raise ValueError("the box is not in order")
    cut = lambda v, most: max(0, min(most, int(v)))
    across, down = width / (high_x - low_x), height / (high_y - low_y)
    left, right = cut((x0 - low_x) * across // 1, width), cut(-(-(x1 - low_x) * across // 1), width)
    top, bottom = cut((high_y - y1) * down // 1, height), cut(-(-(high_y - y0) * down // 1), height)
    if right <= left or bottom <= top:
        raise ValueError("the box lies beside the raster")
    return left, top, right, bottom


def cells_of(height: int, width: int, rows: int, columns: int) -> list[Column]:
    return [cell(F.col("y"), height, rows).alias("row"), cell(F.col("x"), width, columns).alias("col")]


def regional_classes(cells: DataFrame, grid: list[Column], *, source: str, again: str, differs: str, excluded: str | None = None) -> DataFrame:
    """(row, col, supported, roundtrip, semantic and their shares) of the cells that the source supports."""
    known = (F.col(source) > 0) & (~F.col(excluded) if excluded else F.lit(True))
    out = cells.groupBy(*grid).agg(count_if(known).alias("supported"), count_if(known & (F.col(again) != F.col(source))).alias("roundtrip"), count_if(known & F.col(differs)).alias("semantic"))
    share = lambda n: F.col(n) / F.greatest("supported", F.lit(1))
    return out.withColumns({"roundtrip_share": share("roundtrip"), "semantic_share": share("semantic")})


def regional_channels(cells: DataFrame, grid: list[Column], *, channel: str, source: str, again: str, excluded: str | None = None) -> DataFrame:
    """Mismatches of each class channel by cell."""
    known = (F.col(source) > 0) & (~F.col(excluded) if excluded else F.lit(True))
    out = cells.groupBy(*grid, channel).agg(count_if(known).alias("supported"), count_if(known & (F.col(source) != F.col(again))).alias("mismatch"))
    return out.filter("supported > 0").withColumn("share", F.col("mismatch") / F.col("supported"))


def channel_report(regional: DataFrame, channel: str) -> DataFrame:
    """Sums of `regional_channels` over cells, and the worst cell's share."""
    return regional.groupBy(channel).agg(F.sum("supported").alias("supported"), F.sum("mismatch").alias("mismatch"), F.max("share").alias("worst")).withColumn("share", F.col("mismatch") / F.greatest("supported", F.lit(1)))


def binary_channels(cells: DataFrame, grid: list[Column], *, channel: str, source: str, again: str) -> DataFrame:
    """Intersection over union of each yes-no channel by cell; cells that neither side has are left out."""
    a, b = F.col(source).cast("boolean"), F.col(again).cast("boolean")
    return cells.groupBy(*grid, channel).agg(count_if(a | b).alias("either"), count_if(a & b).alias("both"), count_if(a != b).alias("differing")).filter("either > 0").withColumn("iou", F.col("both") / F.col("either"))


def native_regions(cells: DataFrame, height: int, width: int, rows: int, columns: int, *, value: str, domain: str, observed: str, inferred: str, mismatch: str, most: float = 0.01) -> DataFrame:
    """Regions of a picture, empty ones left out: complete if every domain cell has a class and is observed or inferred, passed if few differ too.

    Bounds are i * size / n rounded half to even, so every cell is in one region.
    """
    edges = lambda size, n: [round(k * size / n) for k in range(1, n)]
    place = lambda c, size, n: sum(((F.col(c) >= e).cast("int") for e in edges(size, n)), F.lit(0))
    own = cells.filter(F.col(domain)).groupBy(place("y", height, rows).alias("row"), place("x", width, columns).alias("col"))
    told = (F.col(value) > 0) & (F.col(observed) | F.col(inferred))
    out = own.agg(F.count("*").alias("domain"), count_if(told).alias("classified"), count_if(F.col(mismatch)).alias("mismatch"))
    return out.withColumn("share", F.col("mismatch") / F.col("domain")).withColumn("passed", (F.col("classified") == F.col("domain")) & (F.col("share") <= most))


def same_values(one: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    """One row: cells, those on one side only, and those that differ in each column, nulls alike: a bit-exact recomputation has none."""
    a, b = one.select(*CELL, F.struct(*columns).alias("a")), other.select(*CELL, F.struct(*columns).alias("b"))
    both = a.join(b, CELL, "full_outer")
    out = both.agg(F.count("*").alias("cells"), count_if(F.col("b").isNull()).alias("missing"), count_if(F.col("a").isNull()).alias("extra"), *[count_if(F.col("a").isNotNull() & F.col("b").isNotNull() & ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))).alias(f"differs_{c}") for c in columns])
    return out.withColumn("passed", sum((F.coalesce(F.col(n), F.lit(0)) for n in ("missing", "extra", *(f"differs_{c}" for c in columns))), F.lit(0)) == 0)


def mask_difference(one: DataFrame, other: DataFrame) -> DataFrame:
    """(y, x, kind): cells that one mask lacks (`missing`) or has beyond the other (`extra`)."""
    a, b = one.select(*CELL).distinct(), other.select(*CELL).distinct()
    return a.join(b, CELL, "left_anti").withColumn("kind", F.lit("missing")).unionByName(b.join(a, CELL, "left_anti").withColumn("kind", F.lit("extra")))


def unclassified_ink(cells: DataFrame, legend: list[tuple[int, int, int]], *, value: str, inside: str, most: float = 8.0) -> DataFrame:
    """Cells inside that are near a legend colour and yet have no class; an accurate layer has none."""
    near = F.lit(False)
    for r, g, b in legend:
        near |= (F.col("r") - r) * (F.col("r") - r) + (F.col("g") - g) * (F.col("g") - g) + (F.col("b") - b) * (F.col("b") - b) <= most * most
    return cells.filter(F.col(inside) & (F.col(value) == 0) & near)


def attested(cells: DataFrame, layer: str, *, value: str, inside: str) -> DataFrame:
    """Classified and empty cells of each layer's interior; a classified cell outside raises."""
    out = cells.groupBy(layer).agg(count_if(F.col(inside) & (F.col(value) > 0)).alias("classified"), count_if(F.col(inside) & (F.col(value) == 0)).alias("empty"), count_if(~F.col(inside) & (F.col(value) > 0)).alias("outside"))
    return out.withColumn("outside", F.when(F.col("outside") > 0, F.raise_error(F.lit("classified cells outside the interior")).cast("long")).otherwise(F.col("outside")))


def same_layers(plan: DataFrame, published: DataFrame, key: str) -> DataFrame:
    """Names on one side only, with the side."""
    a, b = plan.select(key).distinct(), published.select(key).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("plan")).unionByName(b.exceptAll(a).withColumn("side", F.lit("published")))


def replaced(before: DataFrame, after: DataFrame, operations: DataFrame, value: str = "class_id") -> DataFrame:
    """Cells whose value after isn't what the operations (y, x, value) make of the one before; an exact application has none."""
    want = before.select(*CELL, F.col(value).alias("_old")).join(operations.select(*CELL, F.col(value).alias("_new")), CELL, "full_outer").select(*CELL, F.coalesce("_new", "_old").alias("wanted"))
    return want.join(after.select(*CELL, F.col(value).alias("found")), CELL, "full_outer").filter(~F.col("wanted").eqNullSafe(F.col("found")))


def ready(catalogue: DataFrame, bound: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, missing, ready): sets of a catalogue with the bindings (tables of the key) that each lacks."""
    out = catalogue.select(key).distinct()
    for name, rows in bound.items():
        out = out.join(rows.select(key, F.lit(True).alias(f"_{name}")).distinct(), key, "left")
    missing = F.array_compact(F.array(*[F.when(F.col(f"_{n}").isNull(), F.lit(n)) for n in bound]))
    return out.select(key, missing.alias("missing"), (F.size(missing) == 0).alias("ready"))


def nonregression(live: DataFrame, candidates: DataFrame, by: str, keys: list[str]) -> DataFrame:
    """(by, better, passed): accepted candidates of a source that rank before its live alignment in `keys`, ascending; a live one without figures fails."""
    whole = F.lit(True)
    for k in keys:
        whole &= F.col(k).isNotNull()
    rank = F.struct(*keys)
    own = live.select(by, F.when(whole, rank).alias("own"))
    other = candidates.filter("accepted").filter(whole).select(by, rank.alias("other"))
    out = own.join(other, by, "left").groupBy(by).agg(F.count(F.when(F.col("other") < F.col("own"), 1)).alias("better"), F.count("own").alias("told"))
    return out.select(by, "better", ((F.col("better") == 0) & (F.col("told") > 0)).alias("passed"))


def failure_report(attempts: DataFrame, by: str, *, score: str, gates: str) -> DataFrame:
    """Attempts, the best score and how often each gate failed, by map."""
    failed = attempts.select(by, F.explode(gates).alias("gate", "ok")).filter("not ok").groupBy(by, "gate").agg(F.count("*").alias("n"))
    told = failed.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("gate", "n")))).alias("failed"))
    return attempts.groupBy(by).agg(F.count("*").alias("attempts"), F.min(score).alias("best")).join(told, by, "left")


def progress(states: DataFrame, by: str, status: str) -> DataFrame:
    """Maps in each state, and their share of all."""
    counts = states.groupBy(status).agg(F.count_distinct(by).alias("maps"))
    total = counts.agg(F.sum("maps").alias("_all"))
    return counts.crossJoin(F.broadcast(total)).select(status, "maps", (F.col("maps") / F.col("_all")).alias("share"))


def source_boxes(cells: DataFrame, grid: list[Column], *, u: str, v: str, width: int, height: int, pad: int = 1) -> DataFrame:
    """The window of the source that each cell of the target needs, by its mapped places (u, v); cells that see nothing are left out."""
    seen = cells.filter(F.col(u).between(0, width - 1) & F.col(v).between(0, height - 1))
    low = lambda c: F.greatest(F.lit(0), F.floor(F.min(c)) - pad).cast("int")
    high = lambda c, most: F.least(F.lit(most), F.ceil(F.max(c)) + 1 + pad).cast("int")
    return seen.groupBy(*grid).agg(F.count("*").alias("n"), low(u).alias("left"), low(v).alias("top"), high(u, width).alias("right"), high(v, height).alias("bottom"))
