"""Connected components of links, in rounds of large-star and small-star steps on written tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specfold.llm.common import drop_path, hot_join, session_of, staged, trimmed

#: So many edges at most are held by a task.
EDGES = 1_000_000


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest node that it is joined to by the pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == root).all():
            return root
        root = new


def _shorten(edges: DataFrame) -> DataFrame:
    """Replaces the edges of each partition, EDGES at a time, by as few that join the same nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= EDGES:
                held = [_short(held)]
                if held[0].num_rows > EDGES // 2:
                    yield held.pop()
        if held:
            yield _short(held)

    return edges.mapInArrow(trimmed(run), "u long, v long")


def _short(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    ends = np.concatenate([b.column(i).to_numpy() for i in (0, 1) for b in held])
    names, place = np.unique(ends, return_inverse=True)  # nodes numbered in their own order, so that roots are smallest
    half = len(ends) // 2
    root = forest(place[:half], place[half:], len(names))
    child = np.flatnonzero(root != np.arange(len(names)))
    return pa.RecordBatch.from_arrays([pa.array(names[child]), pa.array(names[root[child]])], ["u", "v"])


def components(edges: DataFrame, folder: str) -> DataFrame:
    """edges: two columns of long, without nulls. Rows: u, v for each node u but the smallest of its component, v.

    Tasks first replace the edges they have by spanning forests. As soon as at most EDGES are left, one task
    ends the search. Until then rounds of large-star and small-star steps follow, each written to folder
    and the one before deleted; of a node's links only partial minima meet in one task, and
    nodes with many links are joined by broadcast (at most 1 / HOT_SHARE of them).
    """
    spark = session_of(edges)
    a, b = edges.columns
    first = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    now = staged(_shorten(first), folder, "star-0")
    seen, turn = None, 0
    while True:
        digest = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if digest == seen or digest[0] == 0:
            return now
        if digest[0] <= EDGES:
            return staged(_shorten(now.repartition(1)), folder, "ended")
        seen, turn = digest, turn + 1
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("links")).select("u", F.least("u", "m").alias("m"), "links")
        large = hot_join(both.where("v > u"), low, "u", "links", 2 * digest[0], "inner").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, folder, f"large-{turn}")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("links"))
        hooked = hot_join(large, least, "u", "links", digest[0], "inner").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = staged(_shorten(hooked.union(least.select("u", F.col("m").alias("v")))).distinct(), folder, f"star-{turn}")
        drop_path(spark, f"{folder}/star-{turn - 1}")
        drop_path(spark, f"{folder}/large-{turn}")
        now = new
