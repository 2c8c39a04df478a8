"""Recognised words: duplicates, lines, numeric columns and labels.

Greedy rules depend on the order within a page, so a page is one group; pages are
independent and small.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def greedy(words: DataFrame, page: str, order: list[str], near: Callable[[dict, dict], bool]) -> DataFrame:
    """Words in order that are near no word kept before, page by page; `order` must name a total order (prefix - for falling)."""
    names, rising = [o.removeprefix("-") for o in order], [not o.startswith("-") for o in order]

    def keep(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(names, ascending=rising, kind="stable")
        kept: list[dict] = []
        flags = []
        for row in frame.to_dict("records"):
            flags.append(not any(near(row, k) for k in kept))
            if flags[-1]:
                kept.append(row)
        return frame[flags]

    return words.groupBy(page).applyInPandas(keep, words.schema)


def same_word(reach: float) -> Callable[[dict, dict], bool]:
    """The same text, letters in either case, with corners within `reach`."""
    return lambda a, b: a["text"].casefold() == b["text"].casefold() and abs(a["left"] - b["left"]) <= reach and abs(a["top"] - b["top"]) <= reach


def same_box(place: float = 3, size: float = 4) -> Callable[[dict, dict], bool]:
    """Boxes alike in place and size."""
    return lambda a, b: all(abs(a[k] - b[k]) <= place for k in ("left", "top")) and all(abs(a[k] - b[k]) <= size for k in ("width", "height"))


def accepted(words: DataFrame, *, sure: float = 65, likely: float = 42, turns: int = 2) -> DataFrame:
    """Words that are sure, or likely and seen at several angles."""
    return words.filter((F.col("conf") >= sure) | ((F.col("conf") >= likely) & (F.col("angles") >= turns)))


def label_lines(words: DataFrame, page: str, line: str, target: str) -> DataFrame:
    """Runs of words of one line whose joined letters and digits equal the target's: (page, line, left, top, right, bottom)."""
    bare = lambda c: F.lower(F.regexp_replace(c, "[^0-9A-Za-z]+", ""))
    wanted = "".join(c for c in target.lower() if c.isalnum() and c.isascii())
    box = F.struct("left", "top", (F.col("left") + F.col("width")).alias("right"), (F.col("top") + F.col("height")).alias("bottom"), bare(F.col("text")).alias("t"))
    rows = words.groupBy(page, line).agg(F.array_sort(F.collect_list(box)).alias("w"))
    runs = rows.select(page, line, "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("i")).select(page, line, "w", "i", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("i") + 1)).alias("n"))
    part = runs.select(page, line, F.slice("w", F.col("i"), F.col("n")).alias("p"))
    hit = part.filter(F.array_join(F.transform("p", lambda e: e["t"]), "") == wanted)
    return hit.select(page, line, F.array_min(F.transform("p", lambda e: e["left"])).alias("left"), F.array_min(F.transform("p", lambda e: e["top"])).alias("top"), F.array_max(F.transform("p", lambda e: e["right"])).alias("right"), F.array_max(F.transform("p", lambda e: e["bottom"])).alias("bottom"))


def restore_points(labels: DataFrame, legend: str, order: str, text: str) -> DataFrame:
    """Numeric labels of a legend get a point before the last digit if at least max(3, 40 %) have one and the result rises strictly; else all stay."""
    w = Window.partitionBy(legend)
    number, point = F.col(text).rlike(r"^\d+(\.\d+)?$"), F.col(text).contains(".")
    put = F.when(point, F.col(text)).otherwise(F.regexp_replace(text, r"^(\d*)(\d)$", "$1.$2"))
    out = labels.withColumns({"_n": F.count("*").over(w), "_all": F.min(number.cast("int")).over(w), "_p": F.sum(point.cast("int")).over(w), "_put": put})
    step = F.lag(F.expr("try_cast(_put as double)")).over(Window.partitionBy(legend).orderBy(order))
    out = out.withColumn("_up", F.coalesce(F.expr("try_cast(_put as double)") > step, step.isNull()).cast("int"))
    ok = (F.col("_all") == 1) & (F.col("_p") >= F.greatest(F.lit(3.0), 0.4 * F.col("_n"))) & (F.min("_up").over(w) == 1)
    return out.withColumn("_ok", ok).withColumn(text, F.when(F.col("_ok"), F.col("_put")).otherwise(F.col(text))).drop("_n", "_all", "_p", "_put", "_up", "_ok")


def falling_column(words: DataFrame, page: str, *, tolerance: float = 6, least: int = 3) -> DataFrame:
    """Longest run of numbers in one column that fall strictly from top to bottom: (page, column, run, n)."""
    n = words.withColumn("v", F.expr("try_cast(text as double)")).filter(F.col("v").isNotNull()).withColumn("column", F.floor((F.col("left") + F.col("width") / 2) / tolerance))
    w = Window.partitionBy(page, "column").orderBy("top", "left")
    starts = n.withColumn("_s", (F.coalesce(F.col("v") >= F.lag("v").over(w), F.lit(True))).cast("int"))
    runs = starts.withColumn("run", F.sum("_s").over(w)).groupBy(page, "column", "run").agg(F.count("*").alias("n"), F.max("v").alias("first"), F.min("v").alias("last"))
    best = runs.filter(F.col("n") >= least).groupBy(page).agg(F.max_by(F.struct("column", "run", "n", "first", "last"), F.struct("n", (-F.col("column")).alias("c"), (-F.col("run")).alias("r"))).alias("b"))
    return best.select(page, "b.*")
