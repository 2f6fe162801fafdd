"""Reading sorted Arrow batches group by group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each run of equal ``key`` values (bigint, no nulls); only the run in hand is held."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy()
        if waiting and waiting[-1].column(key)[-1].as_py() != values[0]:
            yield pa.Table.from_batches(waiting)
            waiting = []
        at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        for a, b in zip(at[:-1], at[1:]):
            yield pa.Table.from_batches([*waiting, batch.slice(a, b - a)])
            waiting = []
        waiting.append(batch.slice(at[-1]))
    if waiting:
        yield pa.Table.from_batches(waiting)


def matrix(column: pa.ChunkedArray, dtype, width: int) -> np.ndarray:
    """A binary column of equal lengths as rows of numbers."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype).reshape(len(column), width)


