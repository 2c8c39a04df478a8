"""Nearest neighbours by multiprobe p-stable hashing, with exact reranking.

Largest inner products become least distances: each vector gets one more
coordinate so that all have the norm of the longest. Each of TABLES tables hashes
with K Gaussian projections cut into cells of width WIDTH; K follows the logarithm
of the number of vectors. A query makes its perturbed buckets by itself: for each
projection the cells next to its own with the estimated probability that a
neighbour at the usual distance lies there, and of their combinations those that
are likely enough to hold, together, the share of neighbours that its tables need
for the recall asked for. They are listed in order of estimated success and looked
up by key. Candidates of all visited buckets are ranked by the exact inner product
of the original vectors, in double precision, and the tables' results are merged.

Buckets lie in blocks by their first coordinates. Large blocks are dealt out to
several groups of at most about BLOCK vectors, queries to groups of QUERIES, and a
query goes only to blocks in which it has a bucket to look up. Each group returns
its best 21 for each query, and all that tie with the last, so candidates are never
emitted as pairs. Equal vectors are one: of their ids the 21 smallest are kept, as
many as a result can hold, so a group of copies of any size costs one candidate.

A sample of at most SAMPLE vectors gives the usual distance of the k-th neighbour;
all vectors are indexed. Defined results: null vectors, zero vectors, those with
null or non-finite components, or of another length than most, take no part;
repeated ids are one per distinct vector; fewer candidates give fewer rows; an
empty table gives none; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

TABLES, WIDTH, RECALL = 2, 2.0, 0.89
BLOCK, QUERIES, SAMPLE = 8192, 2048, 8192
DRAWS = 512
REACH = 8  # cells to either side that a projection may be perturbed by


@dataclass
class Index:
    """Projections and what the sample says."""

    planes: np.ndarray  # TABLES x (dimension + 1) x K
    offsets: np.ndarray  # TABLES x K
    longest: float
    distance: float  # of the k-th neighbour, longest norm = 1
    lead: int  # coordinates that name a block

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Rows scaled to norm 1, with the coordinate that makes inner products distances."""
        norms = np.sqrt((x * x).sum(1))
        y = x / (norms[:, None] if query else self.longest)
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, 1 - (norms / self.longest) ** 2))
        return np.concatenate([y, extra[:, None]], 1)

    def places(self, x: np.ndarray, table: int, query: bool = False) -> np.ndarray:
        """Positions on the projections, in cell widths."""
        return (self.lifted(x, query) @ self.planes[table] + self.offsets[table]) / WIDTH

    def log_share(self, place: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Log probability that a neighbour of a query at `place` falls into each cell, by coordinate."""
        s = self.distance / WIDTH
        z = lambda v: normal((v - place) / s)
        return np.log(np.maximum(1e-12, z(cells + 1.0) - z(cells + 0.0)))

    def cut(self, place: np.ndarray, table: int) -> float:
        """The least log probability of cells that are visited: those likelier hold the share needed."""
        need = 1 - (1 - RECALL) ** (1 / TABLES)
        drawn = np.random.default_rng(table).standard_normal((DRAWS, len(place))) * (self.distance / WIDTH) + place
        return float(np.quantile(self.log_share(place, np.floor(drawn)).sum(1), 1 - need))


    def probes(self, place: np.ndarray, table: int) -> np.ndarray:
        """The buckets that a query at `place` visits, likeliest first: combinations of cells by coordinate, cut where the rest is too unlikely."""
        least = self.cut(place, table) - 1e-9
        reach = np.arange(-REACH, REACH + 1)
        cells = np.floor(place)[:, None] + reach
        share = self.log_share(place[:, None], cells)
        rest = np.concatenate([np.cumsum(share.max(1)[::-1])[::-1][1:], [0.0]])
        found, score = np.zeros((1, 0), np.int64), np.zeros(1)
        for k in range(len(place)):
            total = score[:, None] + share[k]
            row, col = np.nonzero(total + rest[k] >= least)
            found, score = np.concatenate([found[row], cells[k, col].astype(np.int64)[:, None]], 1), total[row, col]
        return found[np.argsort(-score, kind="stable")]


def bucket_keys(cells: np.ndarray) -> np.ndarray:
    """A 64-bit key of each row of cells."""
    out = np.zeros(len(cells), np.uint64)
    for k in range(cells.shape[1]):
        out = (out ^ cells[:, k].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def normal(z: np.ndarray) -> np.ndarray:
    """The normal distribution function, by the series of Zelen and Severo (error under 8e-8)."""
    t = 1 / (1 + 0.2316419 * np.abs(z))
    tail = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(z >= 0, 1 - tail, tail)


def matrix(column: pa.Array) -> np.ndarray:
    values = column.values.slice(column.offsets[0].as_py(), column.offsets[-1].as_py() - column.offsets[0].as_py()) if len(column) else column.values
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unsigned_zeros(table: DataFrame, vector: str) -> Column:
    """The vector with 0 for -0, so that equal vectors are equal values."""
    kind = table.schema[vector].dataType.elementType.simpleString()
    return F.transform(vector, lambda c: c + F.lit(0).cast(kind))


def distinct_vectors(table: DataFrame, key: str, vector: str, keep: int) -> DataFrame:
    """(rep, members, v): each distinct usable vector, its least id and the `keep` least ids that have it."""
    usable = f"{vector} is not null and size({vector}) > 0 and forall({vector}, c -> c is not null and not isnan(c) and abs(c) < double('Infinity')) and exists({vector}, c -> c <> 0)"
    rows = table.filter(F.col(key).isNotNull()).filter(usable).select(F.col(key).cast("long").alias("id"), unsigned_zeros(table, vector).alias("v"))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is not None:
        rows = rows.filter(F.size("v") == size["n"])
    ranked = rows.withColumn("at", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("at") <= keep)
    return common.stored(ranked.groupBy("v").agg(F.min("id").alias("rep"), F.array_sort(F.collect_list("id")).alias("members")).select("rep", "members", "v"), "vectors")


def build(reps: DataFrame, top: int) -> Index | None:
    stats = reps.agg(F.count("*").alias("n"), F.max(F.expr("aggregate(v, double(0), (a, c) -> a + double(c) * double(c))")).alias("q"), F.max(F.size("v")).alias("d")).first()
    n, dim = stats["n"], stats["d"]
    if not n:
        return None
    longest = math.sqrt(stats["q"])
    k = max(4, round(0.6 * math.log2(n)))
    rng = np.random.default_rng(20240229)
    planes, offsets = rng.standard_normal((TABLES, dim + 1, k)), rng.random((TABLES, k)) * WIDTH
    index = Index(planes, offsets, longest, 1.0, min(k - 1, max(1, math.ceil(math.log(max(1, n / BLOCK), 3)))))
    # Bounded: SAMPLE vectors at most about, whatever n.
    rows = reps.filter(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / n) * (1 << 30))).select("v").toArrow().column(0).combine_chunks()
    sample = matrix(rows.chunk(0) if isinstance(rows, pa.ChunkedArray) else rows)
    if len(sample) > 2:
        queries, nth = sample[:256], max(1, round(top * len(sample) / n))
        dots = index.lifted(queries, True) @ index.lifted(sample).T
        dots[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
        nth = min(nth, len(sample) - 1)
        near = np.sqrt(np.maximum(0.0, 2 - 2 * np.sort(dots, 1)[:, -nth]))
        index.distance = max(1e-3, float(np.quantile(near, 0.6)))
    return index


def search(table: DataFrame, *, key: str = "vec_id", vector: str = "embedding", every: int = 20, top: int = 20) -> DataFrame:
    """(query_id, rank, key, score): nearest of every usable row whose id is divisible by `every`."""
    spark = table.sparkSession
    out = f"query_id long, rank int, {key} long, score double"
    reps = distinct_vectors(table, key, vector, top + 1)
    index = build(reps, top)
    if index is None:
        return spark.createDataFrame([], out)
    held = spark.sparkContext.broadcast(index)
    lead, names = index.lead, [f"c{i}" for i in range(index.lead)]
    place = ", ".join(["t int", *(f"{c} int" for c in names)])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = held.value
        for batch in batches:
            x = matrix(batch.column(1))
            for t in range(TABLES):
                at = np.floor(ix.places(x, t)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), *(pa.array(at[:, i].copy()) for i in range(lead)), *batch.columns], names=["t", *names, "rep", "v"])

    placed = common.spread(reps.select("rep", "v")).mapInArrow(cells, f"{place}, rep long, v {reps.schema['v'].dataType.simpleString()}")
    counts = placed.groupBy("t", *names).agg(F.count("*").alias("n"))
    blocks = common.stored(counts.select("t", *names, F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")), "blocks")

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = held.value
        for batch in (piece for b in batches for piece in common.slices(b, 256)):
            x = matrix(batch.column(1))
            for t in range(TABLES):
                rows, where, keys = [], [], []
                for i, p in enumerate(ix.places(x, t, True)):
                    found = ix.probes(p, t)  # the query's own cell is among them, or a likelier one
                    heads, which = np.unique(found[:, :lead], axis=0, return_inverse=True)
                    inner, order = bucket_keys(found[:, lead:]), np.argsort(which.ravel(), kind="stable")
                    ends = np.cumsum(np.bincount(which.ravel(), minlength=len(heads)))[:-1]
                    rows += [i] * len(heads)
                    where.append(heads)
                    keys += np.split(inner[order], ends)[: len(heads)]
                where = np.concatenate([np.zeros((0, lead), np.int64), *where]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), t, np.int32)), *(pa.array(where[:, i].copy()) for i in range(lead)), *(c.take(pa.array(rows, pa.int64())) for c in batch.columns), pa.array(keys, pa.list_(pa.int64()))],
                    names=["t", *names, "rep", "v", "probes"],
                )

    # By vector: a group of copies may have its divisible ids beyond those kept.
    divisible = table.filter(F.col(key) % every == 0).select(F.col(key).cast("long").alias("query_id"), unsigned_zeros(table, vector).alias("v")).join(reps.select("rep", "v"), "v").select("query_id", "rep").distinct()
    owners = common.stored(divisible, "owners")
    asking = reps.join(owners.select("rep").distinct(), "rep", "left_semi").select("rep", "v")
    asked = common.spread(asking).mapInArrow(visits, f"{place}, rep long, v {reps.schema['v'].dataType.simpleString()}, probes array<long>")
    # Blocks that hold nothing fall out; a block in several parts is asked in each.
    asked = asked.join(blocks, ["t", *names]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    asked = asked.withColumn("deal", F.pmod(F.xxhash64("rep"), F.lit(max(1, math.ceil(owners.count() / QUERIES)))))
    asked = common.stored(asked, "asked")
    deals = asked.select("t", *names, "part", (F.col("deal") + 0).alias("deal")).distinct()
    dealt = placed.join(blocks, ["t", *names]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).drop("parts")
    dealt = dealt.join(deals, ["t", *names, "part"])

    def best(group: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ix, t = held.value, int(group[0])
        none = pd.DataFrame({"query": np.zeros(0, np.int64), "rep": np.zeros(0, np.int64), "score": np.zeros(0)})
        if left.empty or right.empty:
            return none
        x, q = np.stack(left["v"].to_numpy()).astype(np.float64), np.stack(right["v"].to_numpy()).astype(np.float64)
        ids, queries, probes = left["rep"].to_numpy(), right["rep"].to_numpy(), right["probes"].to_numpy()
        buckets, inverse = np.unique(bucket_keys(np.floor(ix.places(x, t)).astype(np.int64)[:, lead:]), return_inverse=True)
        slack = 1e-9 * ix.longest * np.sqrt((q * q).sum(1))
        out = []
        for begin in range(0, len(q), 256):
            near = x @ q[begin : begin + 256].T  # may differ from the exact sums in the last bits
            for k in range(begin, min(begin + 256, len(q))):
                at = np.minimum(np.searchsorted(buckets, probes[k]), len(buckets) - 1)
                visited = np.zeros(len(buckets), bool)
                visited[at[buckets[at] == probes[k]]] = True
                found = np.flatnonzero(visited[inverse])
                if len(found) > top + 1:
                    rough = near[found, k - begin]
                    found = found[rough >= np.partition(rough, -(top + 1))[-(top + 1)] - slack[k]]
                score = (x[found] * q[k]).sum(1)
                pick = np.lexsort((ids[found], -score))[: top + 1]
                out.append((np.full(len(pick), queries[k]), ids[found[pick]], score[pick]))
        return pd.DataFrame(dict(zip(("query", "rep", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    keys = ["t", *names, "part", "deal"]
    near = dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(best, "query long, rep long, score double").groupBy("query", "rep").agg(F.max("score").alias("score"))
    ranked = near.withColumn("at", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "rep"))).filter(F.col("at") <= top + 1)
    listed = ranked.join(reps.select("rep", "members"), "rep").groupBy("query").agg(F.flatten(F.collect_list(F.transform("members", lambda m: F.struct((-F.col("score")).alias("s"), m.alias("id"))))).alias("all"))
    first = listed.select(F.col("query").alias("rep"), F.slice(F.array_sort("all"), 1, top + 1).alias("all"))
    mine = owners.join(first, "rep").select("query_id", F.posexplode(F.expr(f"slice(filter(all, e -> e.id <> query_id), 1, {top})")).alias("pos", "e"))
    return mine.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("e.id").alias(key), (-F.col("e.s")).alias("score"))
