"""Small helpers for Arrow-batched Python stages."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def texts(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """The column's texts, null as empty."""
    return [x or "" for x in column.to_pylist()]


def flat_lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """One list per array without a Python object per value."""
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int64)
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(values, kind)).cast(pa.list_(kind))


def groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Consecutive rows with one value of ``key``, whatever batches they came in."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.array(batch.column(key).to_pylist(), dtype=object)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
