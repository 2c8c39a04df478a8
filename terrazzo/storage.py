"""Tables between rounds, in the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; one on this machine only where Spark runs on it alone and names none."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), "terrazzo-checkpoints")
    return found.rstrip("/")


@contextlib.contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is executed here go as soon as it is over; the session's setting comes back."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def written(df: DataFrame) -> DataFrame:
    """`df` as Parquet in the shared folder, and a reader of it; the files go when the session ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/terrazzo/rounds-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    with freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """`df` as one side of a join by key that must not be broadcast: cells pack so well that Spark takes files of millions of rows for small."""
    return df.hint("merge")
