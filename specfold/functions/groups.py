"""Whole groups out of key-sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str, most: int = 16_000_000) -> Iterator[pa.Table]:
    """Tables of one or more whole groups of equal integer key, about `most` bytes each."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            table = pa.Table.from_batches(held).combine_chunks()
            values = table.column(key).to_numpy()
            cut = int(np.searchsorted(values, values[-1]))
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            size = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
