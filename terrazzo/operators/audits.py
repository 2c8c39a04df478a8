"""Audits: counts and gates over joined rasters, a grid cell or a map at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import cell
from . import graphs

CELL = ["y", "x"]


def count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def coverage(cells: DataFrame, *, value: str, state: str, evidence: str, sparse: bool, by: list[str] | None = None) -> DataFrame:
    """Unclassified cells, dropped and added evidence, and whether the gate of the mode holds."""
    has, v = F.col(evidence), F.col(value) > 0
    counts = cells.groupBy(*(by or [])).agg(
        count_if(F.col(state)).alias("domain"),
        count_if(F.col(state) & ~v).alias("unclassified"),
        count_if(has & ~v).alias("dropped"),
        count_if(v & ~has).alias("unsupported"),
        count_if(v & ~F.col(state)).alias("outside"),
    )
    ok = (F.col("dropped") == 0) & (F.col("outside") == 0) & ((F.col("unsupported") == 0) if sparse else (F.col("unclassified") == 0))
    return counts.withColumn("passed", ok)


def grid_metrics(cells: DataFrame, *, height: int, width: int, rows: int, columns: int, domain: Column, observed: Column, matched: Column | None = None, least: int = 1) -> DataFrame:
    """Domain, observed and matched counts and shares of each grid cell with at least `least` domain cells."""
    out = cells.filter(domain).groupBy(cell(F.col("y"), height, rows).alias("row"), cell(F.col("x"), width, columns).alias("col"))
    aggs = [F.count("*").alias("domain"), count_if(observed).alias("observed")]
    if matched is not None:
        aggs.append(count_if(observed & matched).alias("matched"))
    found = out.agg(*aggs).filter(F.col("domain") >= least).withColumn("observed_share", F.col("observed") / F.col("domain"))
    return found.withColumn("matched_share", F.col("matched") / F.col("domain")) if matched is not None else found


def transitions(old: DataFrame, new: DataFrame, value: str = "class_id") -> DataFrame:
    """Counts of cells that change class, no data as 0."""
    both = old.select(*CELL, F.col(value).alias("old")).join(new.select(*CELL, F.col(value).alias("new")), CELL, "full_outer")
    pair = both.select(F.coalesce("old", F.lit(0)).alias("old"), F.coalesce("new", F.lit(0)).alias("new"))
    return pair.filter("old <> new").groupBy("old", "new").agg(F.count("*").alias("n"))


def total_variation(counts: DataFrame, group: str, colour: str, n: str = "n") -> DataFrame:
    """Half the summed differences of shares for every pair of groups, over the union of their colours.

    The table holds one row a group and colour, not a pixel; sizes are those of a legend.
    """
    shares = counts.withColumn("p", F.col(n) / F.sum(n).over(Window.partitionBy(group)))
    a = shares.select(F.col(group).alias("a"), F.col(colour).alias("c"), F.col("p"))
    b = shares.select(F.col(group).alias("b"), F.col(colour).alias("c"), F.col("p").alias("q"))
    # sum |p - q| = 2 - 2 sum min(p, q) where both sum to 1
    groups = shares.select(group).distinct()
    pairs = groups.select(F.col(group).alias("a")).join(groups.select(F.col(group).alias("b")), F.expr("a < b"))
    shared = a.join(b, "c").filter("a < b").groupBy("a", "b").agg(F.sum(F.least("p", "q")).alias("s"))
    return pairs.join(shared, ["a", "b"], "left").select("a", "b", (1 - F.coalesce("s", F.lit(0.0))).alias("tv"))


def shared_palette(counts: DataFrame, group: str, colour: str, groups: int, least: float = 0.005, n: str = "n") -> DataFrame:
    """Colours that every group holds with at least a share."""
    shares = counts.withColumn("p", F.col(n) / F.sum(n).over(Window.partitionBy(group)))
    return shares.groupBy(colour).agg(F.count("*").alias("k"), F.min("p").alias("p")).filter((F.col("k") == groups) & (F.col("p") >= least)).select(colour, F.col("p").alias("least_share"))


def confusable_groups(pairs: DataFrame) -> DataFrame:
    """(node, group_id) of groups linked by pairs (a, b), however long their chains; group_id: the least node."""
    return graphs.components(pairs).select("node", F.col("component").alias("group_id"))


def residuals(rows: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Count, median, 90th percentile, largest, root mean square, and shares within 3, 5 and 8."""
    v = F.col(value)
    return rows.groupBy(*(by or [])).agg(
        F.count(v).alias("n"),
        F.percentile(v, F.lit(0.5)).alias("median"),
        F.percentile(v, F.lit(0.9)).alias("p90"),
        F.max(v).alias("largest"),
        F.sqrt(F.avg(v * v)).alias("rms"),
        *[F.avg((v <= k).cast("double")).alias(f"within_{k}") for k in (3, 5, 8)],
    )


def balanced_gate(cells: DataFrame, *, passed: str = "passed", least_cells: int = 8, share: float = 0.7, edge: float = 0.5) -> DataFrame:
    """One row: enough supported cells, enough of them pass, and every row and column passes half."""
    whole = cells.agg(F.count("*").alias("cells"), F.avg(F.col(passed).cast("double")).alias("share"))
    rows = cells.groupBy("row").agg(F.avg(F.col(passed).cast("double")).alias("s")).agg(F.min("s").alias("worst_row"))
    columns = cells.groupBy("col").agg(F.avg(F.col(passed).cast("double")).alias("s")).agg(F.min("s").alias("worst_column"))
    one = whole.crossJoin(rows).crossJoin(columns)  # one row each
    return one.withColumn("balanced", (F.col("cells") >= least_cells) & (F.col("share") >= share) & (F.col("worst_row") >= edge) & (F.col("worst_column") >= edge))


def tolerant_scores(truth: DataFrame, found: DataFrame, tolerance: int = 1) -> DataFrame:
    """Exact IoU, and precision, recall and F1 where a cell counts if the other mask has one within `tolerance`."""
    t, f = truth.select(*CELL).distinct(), found.select(*CELL).distinct()

    def near(mask: DataFrame) -> DataFrame:
        r = F.sequence(F.lit(-tolerance), F.lit(tolerance))
        grown = mask.withColumn("dy", F.explode(r)).withColumn("dx", F.explode(r))
        return grown.select((F.col("y") + F.col("dy")).alias("y"), (F.col("x") + F.col("dx")).alias("x")).distinct()

    flags = t.withColumn("t", F.lit(1)).join(f.withColumn("f", F.lit(1)), CELL, "full_outer").join(near(t).withColumn("nt", F.lit(1)), CELL, "left").join(near(f).withColumn("nf", F.lit(1)), CELL, "left")
    sums = flags.agg(F.count("*").alias("either"), *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in ((F.col("t") * F.col("f"), "both"), (F.col("t"), "truth"), (F.col("f"), "found"), (F.col("t") * F.col("nf"), "t_hit"), (F.col("f") * F.col("nt"), "f_hit"))])
    out = sums.withColumns({"iou": F.try_divide("both", "either"), "precision": F.try_divide("f_hit", "found"), "recall": F.try_divide("t_hit", "truth")})
    return out.withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).select("iou", "precision", "recall", "f1")


def octants(points: DataFrame, value: str) -> DataFrame:
    """Count, median and largest value by octant around the points' centre; points on an edge of octants fall in none."""
    centre = points.agg(F.avg("y").alias("cy"), F.avg("x").alias("cx"))
    turn = F.degrees(F.atan2(F.col("y") - F.col("cy"), F.col("x") - F.col("cx")))
    at = F.pmod(F.rint(turn / 45.0), F.lit(8.0)).cast("int")
    off = F.abs(turn - 45.0 * F.rint(turn / 45.0))
    return points.crossJoin(F.broadcast(centre)).withColumns({"octant": at, "off": off}).filter(F.col("off") < 22.5).groupBy("octant").agg(F.count("*").alias("n"), F.percentile(value, F.lit(0.5)).alias("median"), F.max(value).alias("largest"))


def unanimous(votes: DataFrame, keys: list[str], value: str, variants: int) -> DataFrame:
    """Cells to which every variant gives the same class."""
    return votes.groupBy(*keys).agg(F.count("*").alias("k"), F.min(value).alias("low"), F.max(value).alias("high")).filter((F.col("k") == variants) & (F.col("low") == F.col("high")) & (F.col("low") > 0)).select(*keys, F.col("low").alias(value))


def patch_overlap(values: DataFrame, size: int = 2, *, colour: str = "colour", label: str = "class_id") -> DataFrame:
    """Jaccard overlap of the k x k patches that each pair of classes shows; patches of one class only."""
    offsets = [(dy, dx) for dy in range(size) for dx in range(size)]
    spread = values.select(label, colour, F.explode(F.array(*[F.struct(F.lit(k).alias("k"), (F.col("y") - dy).alias("py"), (F.col("x") - dx).alias("px")) for k, (dy, dx) in enumerate(offsets)])).alias("o"))
    patches = spread.groupBy("o.py", "o.px").agg(F.count("*").alias("n"), F.min(label).alias("low"), F.max(label).alias("high"), F.transform(F.array_sort(F.collect_list(F.struct("o.k", colour))), lambda s: s[colour]).alias("patch"))
    kinds = patches.filter((F.col("n") == size * size) & (F.col("low") == F.col("high")) & (F.col("low") > 0)).select(F.col("low").alias(label), "patch").distinct()
    sizes = kinds.groupBy(label).agg(F.count("*").alias("n"))
    shared = kinds.select(F.col(label).alias("a"), "patch").join(kinds.select(F.col(label).alias("b"), "patch"), "patch").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("both"))
    pairs = sizes.select(F.col(label).alias("a"), F.col("n").alias("na")).join(sizes.select(F.col(label).alias("b"), F.col("n").alias("nb")), F.expr("a < b"))
    return pairs.join(shared, ["a", "b"], "left").select("a", "b", F.coalesce("both", F.lit(0)).alias("both"), (F.coalesce("both", F.lit(0)) / (F.col("na") + F.col("nb") - F.coalesce("both", F.lit(0)))).alias("jaccard"))


def chi_square(counts: DataFrame, row: str, column: str, n: str = "n") -> DataFrame:
    """The statistic and degrees of freedom of a contingency table, empty cells included by arithmetic."""
    table = counts.groupBy(row, column).agg(F.sum(n).alias("o"))
    total = F.sum("o").over(Window.partitionBy())
    cells = table.withColumns({"r": F.sum("o").over(Window.partitionBy(row)), "c": F.sum("o").over(Window.partitionBy(column)), "t": total})
    # sum (o - e)^2 / e over all cells = sum o^2 / e - t
    return cells.agg(F.sum(F.col("o") * F.col("o") * F.col("t") / (F.col("r") * F.col("c"))).alias("s"), F.max("t").alias("t"), F.count_distinct(row).alias("nr"), F.count_distinct(column).alias("nc")).select((F.col("s") - F.col("t")).alias("chi2"), ((F.col("nr") - 1) * (F.col("nc") - 1)).alias("dof"))
