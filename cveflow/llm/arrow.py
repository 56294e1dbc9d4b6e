"""Arrow batches as NumPy arrays, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that a task works on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 21


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``rows`` rows and ``limit`` bytes of text, or one row."""
    column = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum(np.diff(offsets(column)))
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = min(at + rows, max(at + 1, int(np.searchsorted(ends, done + limit, "right"))))
        yield batch.slice(at, to - at)
        at = to


def offsets(column: pa.Array) -> np.ndarray:
    """Byte (or item) offsets of a string (or list) column."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_list(column.type) else np.int32
    buffer = column.buffers()[1]
    if buffer is None or len(column) == 0:
        return np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(buffer, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and the offset of each text in them."""
    at = offsets(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def strings(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """A string column from all its bytes (valid UTF-8) and offsets."""
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]).cast(pa.string())


def lists(items: np.ndarray, at: np.ndarray) -> pa.Array:
    """A list column from all its items and offsets."""
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(items))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of ``[start, start + length)`` of every pair, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
