"""Word shingles of whole slices of text as NumPy arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

WORDS = 5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTES = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.random.default_rng(12).integers(0, 2**64, WORDS, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lower-cased, and the number of words of each text."""
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < len(data)]
    begins[edges] = inside[edges]
    start = np.flatnonzero(begins)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(at) - 1, np.int64)
    byte = np.flatnonzero(inside)
    first = np.searchsorted(byte, start)
    size = np.diff(np.append(first, len(byte)))
    place = np.arange(len(byte)) - np.repeat(first, size)
    power = np.cumprod(np.full(int(size.max()), _BASE))
    total = np.add.reduceat(_BYTES[_LOWER[data[byte]]] * power[place], first)
    return mix(total + size.astype(np.uint64)), np.diff(np.searchsorted(start, at))


def sets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and offsets; fewer words than a shingle has are one shingle."""
    words, counts = _words(data, at)
    ends = np.cumsum(counts)
    begins = ends - counts
    sizes = np.where(counts == 0, 0, np.maximum(counts - WORDS + 1, 1))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    padded = np.append(words, np.zeros(WORDS, np.uint64))
    where = np.arange(bounds[-1]) + np.repeat(begins - bounds[:-1], sizes)
    short = np.repeat(counts < WORDS, sizes)
    left = np.repeat(ends, sizes)
    total = np.where(short, np.repeat(counts, sizes).astype(np.uint64), np.uint64(WORDS))
    for k in range(WORDS):
        part = padded[where + k] * _PLACES[k]
        total = total + np.where(where + k < left, part, np.uint64(0))
    hashed = mix(total)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        hashed[a:b].sort()
    keep = np.ones(len(hashed), bool)
    keep[1:] = hashed[1:] != hashed[:-1]
    keep[bounds[:-1][bounds[:-1] < len(hashed)]] = True
    return hashed[keep], np.concatenate(([0], np.cumsum(keep)))[bounds]


def minima(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """MinHash: for each non-empty set (row) and each of ``n`` hash functions the smallest value."""
    # the first functions are the same whatever n is
    factors = np.random.default_rng(13).integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)
    shifts = np.random.default_rng(14).integers(0, 2**64, n, dtype=np.uint64)
    starts = at[:-1][np.diff(at) > 0]
    out = np.empty((len(starts), n), np.uint32)
    for k in range(n):
        values = ((hashes * factors[k] + shifts[k]) >> np.uint64(32)).astype(np.uint32)
        out[:, k] = np.minimum.reduceat(values, starts) if len(starts) else 0
    return out


def fingerprints(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that identify each set; 0 for an empty one."""
    out = []
    for seed in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
        summed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(seed)))))
        out.append((summed[at[1:]] - summed[at[:-1]]).view(np.int64))
    return out[0], out[1]
