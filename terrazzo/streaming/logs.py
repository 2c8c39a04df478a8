"""Attempts as an append-only stream, and what they amount to.

The state of a map is the last of its events; a batch that is replayed adds nothing,
since an event is known by (map, attempt, phase).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCHEMA = "map string, attempt int, phase string, gates map<string,boolean>, decision string, at timestamp"
PHASES = ("alignment", "extraction")


def accepted(events: DataFrame) -> DataFrame:
    """Whether an event's gates all hold; an accepting decision without them counts as refused."""
    every = F.forall(F.map_values("gates"), lambda g: g)
    return events.withColumn("accepted", (F.col("decision") == "accept") & F.coalesce(every, F.lit(False)))


def state(events: DataFrame) -> DataFrame:
    """(map, attempts, accepted phases, status): complete needs every phase accepted; blocked is the last word otherwise."""
    known = accepted(events.dropDuplicates(["map", "attempt", "phase"]))
    last = F.max_by("decision", F.struct("attempt", "phase"))
    sums = known.groupBy("map").agg(F.count_distinct("attempt").alias("attempts"), F.array_sort(F.collect_set(F.when(F.col("accepted"), F.col("phase")))).alias("phases"), last.alias("last"))
    status = F.when(F.size("phases") == len(PHASES), "complete").when(F.col("last") == "block", "blocked").otherwise("open")
    return sums.select("map", "attempts", "phases", status.alias("status"))


def resumable(manifest: DataFrame, events: DataFrame) -> DataFrame:
    """Maps of a manifest that still need work, those never tried included, in manifest order."""
    now = state(events)
    return manifest.join(now, "map", "left").filter(F.coalesce("status", F.lit("open")) == "open").orderBy("seq")


def follow(stream: DataFrame, path: str, checkpoint: str):
    """Append a stream of events to Parquet, each event once; returns the running query."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(["map", "attempt", "phase"])
        try:
            old = spark.read.schema(SCHEMA).parquet(path)
            fresh = fresh.join(old.select("map", "attempt", "phase"), ["map", "attempt", "phase"], "left_anti").select(*batch.columns)
        except Exception as e:  # the first batch finds no table yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        fresh.write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rates(stream: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Attempts and acceptances in event-time windows, late events dropped after the watermark."""
    events = accepted(stream).withWatermark("at", late)
    return events.groupBy(F.window("at", width), "phase").agg(F.count("*").alias("attempts"), F.sum(F.col("accepted").cast("int")).alias("accepted"))


def latest(events: DataFrame) -> DataFrame:
    """The last event of each map and phase."""
    w = Window.partitionBy("map", "phase").orderBy(F.desc("attempt"))
    return events.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
