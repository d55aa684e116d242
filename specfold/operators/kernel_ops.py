"""Runs NumPy kernels over array columns: row-local in Arrow batches, or on whole groups of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Values of an array column that a kernel gets at once.
BLOCK_VALUES = 2_000_000


def block_of(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, rows x channels) for each array length that occurs; null arrays are left out, null channels NaN."""
    values = column.cast(pa.large_list(pa.float64()))
    sizes = np.array([-1 if n is None else n for n in pc.list_value_length(values).to_pylist()], np.int64)
    starts = values.offsets.to_numpy()[:-1]
    flat = pc.fill_null(values.values, float("nan")).to_numpy(zero_copy_only=False)
    out = []
    for n in np.unique(sizes[sizes >= 0]):
        rows = np.flatnonzero(sizes == n)
        out.append((rows, flat[starts[rows][:, None] + np.arange(n)[None, :]] if n else np.zeros((len(rows), 0))))
    return out


def lists_of(rows: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if r is None else len(r) for r in rows]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = np.concatenate([r for r in rows if r is not None] or [np.zeros(0)])
    missing = np.array([r is None for r in rows])
    arr = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.float64()), mask=pa.array(missing) if missing.any() else None)
    return arr


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    if not batch.num_rows:
        return
    width = max(1, batch.column(column).nbytes // 8 // batch.num_rows)
    step = max(1, BLOCK_VALUES // width)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def map_arrays(df: DataFrame, column: str, kernel: Callable[..., np.ndarray | tuple], outputs: dict[str, str], extra: tuple[str, ...] = ()) -> DataFrame:
    """Adds or replaces columns by kernel(rows x channels, *extra columns as arrays).

    outputs: name -> "array<double>", "double" or "long"; the kernel returns one array for each (a tuple if
    more than one). Rows of unlike lengths are handled apart; a null array gives nulls. extra: numeric columns.
    """
    names = [c for c in df.columns if c not in outputs]
    keep = df.select(*names, *[F.col(c).alias(f"_in_{c}") for c in outputs if c in df.columns])
    source = f"_in_{column}" if column in outputs else column
    kinds = {"array<double>": T.ArrayType(T.DoubleType()), "double": T.DoubleType(), "long": T.LongType()}
    schema = T.StructType([*[keep.schema[n] for n in names], *[T.StructField(n, kinds[k]) for n, k in outputs.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, source):
                made: dict[str, list] = {n: [None] * part.num_rows for n in outputs}
                more = [part.column(f"_in_{c}" if c in outputs else c).to_numpy(zero_copy_only=False) for c in extra]
                for rows, block in block_of(part.column(source)):
                    got = kernel(block, *[m[rows] for m in more])
                    for (name, kind), result in zip(outputs.items(), got if isinstance(got, tuple) else (got,), strict=True):
                        for r, x in zip(rows.tolist(), result if kind.startswith("array") else np.asarray(result).tolist(), strict=True):
                            made[name][r] = x
                columns = [lists_of(made[n]) if k.startswith("array") else pa.array(made[n], pa.float64() if k == "double" else pa.int64()) for n, k in outputs.items()]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *columns], [*names, *outputs])

    return keep.mapInArrow(run, schema)
