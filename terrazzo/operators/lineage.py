"""Hash-bound artifacts: digests, verification, two-pass signatures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def content_hashes(files: DataFrame, path: str, content: str) -> DataFrame:
    return files.select(F.col(path).alias("path"), F.sha2(F.col(content).cast("binary"), 256).alias("sha256"))


def verify(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Each declared or found path: ok, changed, missing or undeclared."""
    both = manifest.select("path", F.col("sha256").alias("declared")).join(files.select("path", F.col("sha256").alias("found")), "path", "full_outer")
    state = F.when(F.col("found").isNull(), "missing").when(F.col("declared").isNull(), "undeclared").when(F.col("found") == F.col("declared"), "ok").otherwise("changed")
    return both.select("path", state.alias("state"))


def bucket_hashes(files: DataFrame, by: str) -> DataFrame:
    """One digest a group: paths and file digests in path order, framed by NUL and LF."""
    line = F.concat("path", F.lit("\0"), "sha256", F.lit("\n"))
    return files.groupBy(by).agg(F.count("*").alias("files"), F.sha2(F.array_join(F.array_sort(F.collect_list(line)), ""), 256).alias("digest"))


def raster_signature(values: DataFrame, columns: list[str]) -> str:
    """An order-free digest of a table: counts and sums of row hashes, from one aggregate."""
    row = values.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(7), *columns)).alias("x")).first()
    return f"{row['n']}:{row['s']}:{row['x']}"


def fixed_point(start: DataFrame, step: Callable[[DataFrame], DataFrame], columns: list[str], *, most: int = 4) -> tuple[DataFrame, int]:
    """Repeat `step` until two passes give the same table; fails after `most`. Steps should write their results."""
    now, seen = start, raster_signature(start, columns)
    for k in range(1, most + 1):
        now = step(now)
        sign = raster_signature(now, columns)
        if sign == seen:
            return now, k
        seen = sign
    raise RuntimeError(f"no fixed point in {most} passes")
