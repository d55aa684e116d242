"""What the operators of this subpackage share: the shared work folder, written stages, joins on hot keys, order."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specfold.shipping import ship

#: A key with at least this share of all rows is joined by broadcast; at most 1 / share keys can have it.
HOT_SHARE = 0.001


#: Bytes of an Arrow batch that Python workers get; a longer text makes a batch of its own.
BATCH_BYTES = "8m"


def prepared_session(spark: SparkSession) -> SparkSession:
    """Sends the package to the executors and keeps Arrow batches small, whatever the texts' length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return ship(spark)


def trimmed(run):
    """The same Arrow function; when a task is done its worker, which stays for later ones, gives back unused memory."""

    def lean(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return lean


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def work_dir(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir, which driver and executors share, deleted when the application ends; a local one only in a local session that names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="specfold-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/specfold-{uuid.uuid4().hex}"
    store, at = _store(spark, path)
    store.mkdirs(at)
    store.deleteOnExit(at)  # results may be read from it as long as the application runs
    return path


def _store(spark: SparkSession, path: str):
    """The file system of a path, any that Spark knows, and the path there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder."""
    store, at = _store(spark, path)
    store.delete(at, True)


def keep_only(spark: SparkSession, folder: str, *names: str) -> None:
    """Deletes all written stages in a work folder but those that are still read."""
    store, at = _store(spark, folder)
    for found in store.listStatus(at):
        if found.getPath().getName() not in names:
            store.delete(found.getPath(), True)


def staged(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Writes df as Parquet and reads it again: lineage ends there and no later loss of an executor recomputes it."""
    spark = session_of(df)
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")
    return spark.read.schema(df.schema).parquet(f"{folder}/{name}")


def hot_join(left: DataFrame, right: DataFrame, key: str, copies: str, total: int, how: str = "left") -> DataFrame:
    """left joined with right, whose rows are unique by key and count left's rows of that key in the column copies.

    Keys with HOT_SHARE of the total rows or more number at most 1 / HOT_SHARE; their rows of
    right are broadcast, so that no task gets all rows of a hot key. The rest is an ordinary join.
    right must be cheap to read twice and narrow. A null key matches nothing.
    """
    bar = max(2.0, total * HOT_SHARE)
    hot = right.where(F.col(copies) >= bar)
    rest = right.where(F.col(copies) < bar)
    marks = hot.select(key).withColumn("_hot", F.lit(True))
    marked = left.join(F.broadcast(marks), key, "left")
    of_hot = marked.where(F.col("_hot")).drop("_hot").join(F.broadcast(hot), key, "inner")
    of_rest = marked.where(F.col("_hot").isNull()).drop("_hot").join(rest, key, how)
    return of_hot.unionByName(of_rest.select(of_hot.columns))


def whole_groups(batches: Iterator[pa.RecordBatch], block: int = 8_000_000) -> Iterator[pa.Table]:
    """Tables of whole groups of equal `key` (an integer), of about block bytes; the rows come sorted by it."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= block:
            table = pa.Table.from_batches(held).combine_chunks()
            key = table.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            size = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_bounds(key: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of each run of equal keys."""
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])).tolist()
    return list(zip(at[:-1], at[1:], strict=True))
