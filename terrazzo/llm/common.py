"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Words are maximal runs of anything but these six characters.
WORD_GAP = "\\x20\\x09-\\x0D"
#: Bytes of one Arrow batch where batches are kept small.
BATCH_BYTES = 4 << 20
TOKENIZER_DIR_HINT = "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Only where the session names none and runs on this machine alone (tests) is one made here.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), "terrazzo-checkpoints")
    return found.rstrip("/")


@contextlib.contextmanager
def held(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting for what is executed here; the session's own comes back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def freed(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Shuffle files of what is executed here go as soon as it is over."""
    return held(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_batches(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """What is executed here hands texts to Python in batches of BATCH_BYTES, however long the texts and large the partitions."""
    return held(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, label: str = "table", *more: DataFrame) -> DataFrame:
    """Write `df`, and `more` of its schema one after another, as Parquet in the shared folder and return a reader.

    This cuts the lineage: a lost executor costs a reread, not a recomputation,
    and every pruned column stays pruned. Shuffle files go with the write, the
    table when the session ends.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    with freed(spark):
        for part in (df, *more):
            part.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the session ends."""
    path = f"{shared_dir(spark)}/terrazzo/{label}-{uuid.uuid4().hex}"
    target, files = hadoop_path(spark, path)
    files.deleteOnExit(target)
    return path


def hadoop_path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            if "/terrazzo/" in folder:
                target, files = hadoop_path(spark, folder)
                files.delete(target, True)


def spread(df: DataFrame) -> DataFrame:
    """`df` over as many partitions as there are cores, where its files split into fewer: texts cost far more than their move."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def passed(keep: tuple[str, ...], *own: str) -> list[str]:
    """The columns to pass through: each once, none that the operator makes itself."""
    return [c for c in dict.fromkeys(keep) if c not in own]


def slices(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of at most so many rows, so that what is made of one stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def portions(batch: pa.RecordBatch, *columns: str, limit: int = 1 << 20) -> Iterator[list[list]]:
    """Lists of column values, for some rows at a time; the last column is the text that is measured."""
    values = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
    begin, held = 0, 0
    for i, text in enumerate(values[-1]):
        held += len(text or "")
        if held >= limit:
            yield [v[begin : i + 1] for v in values]
            begin, held = i + 1, 0
    if begin < batch.num_rows:
        yield [v[begin:] for v in values]


class Memo(dict):
    """A cache of `make(key)`, bounded by `room` entries and by the characters of string keys (`letters`; 0: keys are numbers); the older half goes when it is full."""

    def __init__(self, make, room: int = 300_000, letters: int = 8_000_000):
        super().__init__()
        self.make, self.room, self.letters, self.held, self.old = make, room, letters, 0, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        size = len(key) if self.letters else 0
        if size > 256:
            return value  # long runs hardly come back
        self.held += size
        if len(self) >= self.room or self.held > self.letters > 0:
            self.old = dict(self)
            self.clear()
            self.held = size
        self[key] = value
        return value

    def all(self, keys: list[str]) -> list:
        """The values of different keys, with the room counted once; more than one such list of new keys is never held beyond it."""
        found = list(map(self.get, keys))
        fresh = [i for i, v in enumerate(found) if v is None]
        make, old = self.make, self.old.get
        for i in fresh:
            value = old(keys[i])
            found[i] = make(keys[i]) if value is None else value
        kept = {k: found[i] for i in fresh if len(k := keys[i]) <= 256}
        size = sum(map(len, kept))
        if len(self) + len(kept) >= self.room or self.held + size > self.letters > 0:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self.update(kept)
        self.held += size
        return found
