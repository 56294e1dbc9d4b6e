"""Words of whole slices of text as NumPy arrays, in parts of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from cveflow.llm.arrow import slices, utf8
from cveflow.llm.shingles import mix

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODES = np.random.default_rng(21).integers(0, 2**64, (2, 256), dtype=np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    return _LOWER[data]


def parts(batch: pa.RecordBatch, apart: np.ndarray, text: str = "text", limit: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``data, at, owner``: bytes and offsets of consecutive texts, and the row of ``batch`` each belongs to.

    A part has about ``limit`` bytes.  A longer text is cut before bytes that are marked in ``apart`` (256
    booleans), the same row in every part; without such a byte it stays whole.  Every row is in some part.
    """
    first = 0
    for part in slices(batch, text, limit):
        data, at = utf8(part.column(part.schema.get_field_index(text)))
        if part.num_rows > 1 or len(data) <= limit:
            yield data, at, np.arange(first, first + part.num_rows)
        else:
            begin = 0
            while begin < len(data) or begin == 0:
                end = begin + limit
                while end < len(data):
                    cuts = np.flatnonzero(apart[data[end : end + limit]])
                    if len(cuts):
                        end += int(cuts[0])
                        break
                    end += limit
                end = min(end, len(data))
                yield data[begin:end], np.array([0, end - begin]), np.array([first])
                begin = end
        first += part.num_rows


def runs(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, size`` of all maximal runs of bytes marked in ``inside``, and the number of runs of each text."""
    marked = inside[data]
    begins = marked.copy()
    begins[1:] &= ~marked[:-1]
    edges = at[:-1][at[:-1] < len(data)]
    begins[edges] = marked[edges]
    start = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(start, at))
    if not len(start):
        return start, start, counts
    byte = np.flatnonzero(marked)
    return start, np.diff(np.append(np.searchsorted(byte, start), len(byte))), counts


def _hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each run."""
    ends = np.cumsum(size)
    place = np.arange(ends[-1]) - np.repeat(ends - size, size)
    byte = data[place + np.repeat(start, size)]
    out = []
    for codes, base in zip(_CODES, _BASES):
        power = np.cumprod(np.full(int(size.max()), base, np.uint64))
        out.append(mix(np.add.reduceat(codes[byte] * power[place], ends - size) + size.astype(np.uint64)))
    return out[0], out[1]


def distinct(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The distinct runs in byte order, and for each run its place among them.

    Runs are told apart by 128 bits of hash.
    """
    if not len(start):
        return np.zeros(0, np.int64), []
    one, two = _hashes(data, start, size)
    _, first, ids = np.unique(one, return_index=True, return_inverse=True)
    if (two != two[first][ids]).any():
        _, first, ids = np.unique(np.stack([one, two], 1), axis=0, return_index=True, return_inverse=True)
        ids = ids.reshape(-1)
    raw = data.tobytes()
    words = [raw[s : s + n] for s, n in zip(start[first].tolist(), size[first].tolist())]
    order = sorted(range(len(words)), key=words.__getitem__)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    return rank[ids], [words[i] for i in order]
