"""Rows meet the model of their flight and pixel, by a broadcast of checked bytes or in sorted streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP = ("mission_id", "telescop")
#: Models of at most so many bytes of numbers are broadcast; each worker process holds them once.
MOST_BYTES = 64 << 20
#: A kernel gets at most so many rows, of about so many bytes.
BLOCK_ROWS = 2048
BLOCK_BYTES = 32 << 20
#: A stream gets a group's rows in slices of about so many.
SLICE_ROWS = 100_000


def model_bytes(models: DataFrame) -> int:
    """Bytes of all numbers of the models' components and means."""
    wide = F.coalesce(F.aggregate("components", F.lit(0).cast("long"), lambda n, c: n + F.size(c)), F.lit(0).cast("long"))
    return int(models.agg(F.sum(wide * 8 + 64)).first()[0] or 0) * (2 if "mean" in models.columns else 1)


def runs_of(keys: list[tuple]) -> Iterator[tuple[tuple, list[int]]]:
    of: dict[tuple, list[int]] = {}
    for i, k in enumerate(keys):
        of.setdefault(k, []).append(i)
    yield from of.items()


def _step(batch: pa.RecordBatch) -> int:
    return max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(1, batch.nbytes // max(1, batch.num_rows))))


def by_model(rows: DataFrame, models: DataFrame, parse: Callable[[dict], object], kernel: Callable[[pa.RecordBatch, object | None], pa.RecordBatch], schema, most_bytes: int = MOST_BYTES) -> DataFrame:
    """kernel(rows of one group, its parsed model or None) over all rows: row_id, mission_id, telescop and others.

    Beyond most_bytes, models and rows are shuffled by group and slice and sorted, models first, so that a task
    holds one model at a time whatever their number and width; a group of many rows is cut into slices by row_id, and its model sent to each.
    """
    if model_bytes(models) <= most_bytes:
        table = models.toArrow()
        known = {(m["mission_id"], m["telescop"]): parse(m) for m in (table.slice(i, 1).to_pylist()[0] for i in range(table.num_rows))}
        sent = rows.sparkSession.sparkContext.broadcast(known)

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = list(zip(*(batch.column(c).to_pylist() for c in GROUP), strict=True))
                for key, places in runs_of(keys):
                    part = batch if len(places) == batch.num_rows else batch.take(pa.array(places))
                    for i in range(0, part.num_rows, _step(batch)):
                        yield kernel(part.slice(i, _step(batch)), sent.value.get(key))

        return rows.mapInArrow(look, schema)

    same = lambda a, b: F.col(f"{a}.mission_id").eqNullSafe(F.col(f"{b}.mission_id")) & F.col(f"{a}.telescop").eqNullSafe(F.col(f"{b}.telescop"))
    counts = rows.groupBy(*GROUP).agg(F.ceil(F.count(F.lit(1)) / SLICE_ROWS).cast("long").alias("_slices"))
    sliced = rows.alias("r").join(counts.alias("c"), same("r", "c")).select(F.struct("r.*").alias("_row"), F.pmod(F.xxhash64("r.row_id"), F.col("_slices")).alias("_slice"))
    spread = models.alias("m").join(counts.alias("c"), same("m", "c")).select(F.struct("m.*").alias("_model"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slices") - 1)).alias("_slice"))
    columns = lambda at: [F.col(f"{at}.mission_id").alias("_mission"), F.col(f"{at}.telescop").alias("_telescop"), "_slice"]
    left = spread.select(*columns("_model"), F.lit(0).alias("_kind"), "_model").withColumn("_row", F.lit(None).cast(sliced.schema["_row"].dataType))
    right = sliced.select(*columns("_row"), F.lit(1).alias("_kind"), F.lit(None).cast(spread.schema["_model"].dataType).alias("_model"), "_row")
    both = left.unionByName(right)
    at = ["_mission", "_telescop", "_slice"]
    ordered = both.repartition(*at).sortWithinPartitions(*at, "_kind")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[tuple, object] | None = None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in at), strict=True))
            kinds = batch.column("_kind").to_numpy()
            for key, places in runs_of(keys):
                first = places[0]
                if kinds[first] == 0:
                    held = (key, parse(batch.column("_model").slice(first, 1).to_pylist()[0]))
                    places = places[1:]
                step = _step(batch)
                for i in range(0, len(places), step):
                    inner = batch.column("_row").take(pa.array(places[i : i + step]))
                    part = pa.RecordBatch.from_arrays(inner.flatten(), [f.name for f in inner.type])
                    yield kernel(part, held[1] if held and held[0] == key else None)

    return ordered.mapInArrow(stream, schema)


def finite_rows(y: np.ndarray) -> np.ndarray:
    return np.isfinite(y).all(1) if y.shape[1] else np.zeros(len(y), bool)
