"""Pixel tables from arrays, words from recognisers, and tables written back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def from_rows(spark: SparkSession, grid: list[list], value: str = "class_id") -> DataFrame:
    """(y, x, value) of a small nested list; nulls are absent."""
    rows = [(y, x, v) for y, line in enumerate(grid) for x, v in enumerate(line) if v is not None]
    kind = "double" if rows and isinstance(rows[0][2], float) else "int"
    return spark.createDataFrame(rows, f"y int, x int, {value} {kind}")


def grid(spark: SparkSession, height: int, width: int) -> DataFrame:
    """(y, x) of every cell, made where it is used."""
    cells = spark.range(height * width)
    return cells.select((F.col("id") / width).cast("int").alias("y"), (F.col("id") % width).cast("int").alias("x"))


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Recognised words from tab-separated rows: level 5 with text, quotes as they stand."""
    raw = spark.read.csv(path, sep="\t", header=True, quote="", mode="FAILFAST")
    words = raw.filter((F.col("level") == 5) & (F.trim("text") != ""))
    ints = [F.col(c).cast("int").alias(c) for c in ("left", "top", "width", "height", "block_num", "par_num", "line_num")]
    return words.select(*ints, F.col("conf").cast("double").alias("conf"), F.trim("text").alias("text"))


def combine_passes(passes: list[DataFrame]) -> DataFrame:
    """Union of recognition passes; block numbers of pass n are moved by n * 10000."""
    first = passes[0]
    for other in passes[1:]:
        if other.columns != first.columns:
            raise ValueError("passes have different columns")
    moved = [p.withColumn("block_num", F.col("block_num") + 10000 * n) for n, p in enumerate(passes)]
    out = moved[0]
    for p in moved[1:]:
        out = out.unionByName(p)
    return out


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(map_id, y, x, r, g, b) of the images in a folder, by Spark's own reader (blue, green, red bytes)."""
    images = spark.read.format("image").option("dropInvalid", True).load(path).select("image.*")
    cells = images.select(F.col("origin").alias("map_id"), "width", "nChannels", "data", F.explode(F.sequence(F.lit(0), F.col("height") * F.col("width") - 1)).alias("i"))
    byte = lambda k: F.conv(F.hex(F.substring("data", F.col("i") * F.col("nChannels") + k + 1, F.lit(1))), 16, 10).cast("int")
    return cells.select("map_id", (F.col("i") / F.col("width")).cast("int").alias("y"), (F.col("i") % F.col("width")).alias("x"), byte(2).alias("r"), byte(1).alias("g"), byte(0).alias("b"))


def write_classes(classes: DataFrame, path: str, *, by: str = "class_id") -> None:
    """A class raster without its no-data cells, a folder a class."""
    classes.filter(F.col(by) > 0).write.partitionBy(by).mode("errorifexists").parquet(path)


def lineitem_pixels(spark: SparkSession, sf_dir: str, size: int = 96) -> DataFrame:
    """A test raster from `lineitem`: one colour a cell, that of the least row there."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    level = lambda c, k, f: (F.round(F.col(c) * k).cast("long") * f)
    cells = rows.select(
        (F.col("l_orderkey") % size).cast("int").alias("y"),
        (F.col("l_partkey") % size).cast("int").alias("x"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", level("l_quantity", 1, 5).alias("r"), level("l_discount", 100, 25).alias("g"), level("l_tax", 100, 31).alias("b")).alias("row"),
    )
    least = cells.groupBy("y", "x").agg(F.min("row").alias("row"))
    return least.select("y", "x", *[F.col(f"row.{c}").cast("int").alias(c) for c in "rgb"])
