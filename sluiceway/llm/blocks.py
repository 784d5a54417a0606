"""Rows of numbers that travel as blocks: a row of the shuffle holds many, column by column, for one bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Entries that a task gathers before it combines and sends them.
FLUSH = 400_000


def packed(key: str, keys: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row for each distinct key, with each column's values of that key as bytes, in the order given."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    ends = np.append(begins[1:], len(keys))
    arrays = [pa.array(keys[begins], pa.int64())]
    for values in columns.values():
        values = values[order]
        arrays.append(pa.array([values[i:j].tobytes() for i, j in zip(begins, ends)], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, [key, *columns])


def unpacked(table: pa.Table, kinds: dict[str, str]) -> dict[str, np.ndarray]:
    """All values of each column of packed rows."""
    return {name: np.frombuffer(b"".join(table[name].to_pylist()), kind) for name, kind in kinds.items()}


def gathered(parts: Iterator[dict[str, np.ndarray]], size: int = FLUSH) -> Iterator[dict[str, np.ndarray]]:
    """Join column sets until they hold ``size`` entries."""
    held: list[dict[str, np.ndarray]] = []
    count = 0
    for part in parts:
        held.append(part)
        count += len(next(iter(part.values())))
        if count >= size:
            yield {name: np.concatenate([p[name] for p in held]) for name in part}
            held, count = [], 0
    if count:
        yield {name: np.concatenate([p[name] for p in held]) for name in held[0]}
