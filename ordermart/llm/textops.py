"""Vectorised text helpers for Arrow batches: words, word hashes, shingles.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, with A-Z folded
to a-z for hashing.  All hashes are 64 bit, seeded by fixed constants, so any
executor gives the same value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_M = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


def _fixed(n: int, seed: int) -> np.ndarray:
    """``n`` 64-bit constants of the splitmix64 sequence."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _fixed(256, 7)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_COEF = _fixed(64, 99) | np.uint64(1)
_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    while len(_POW[0]) < n:
        k = len(_POW[0])
        for i, base in enumerate((_BASE, _INV)):
            step = np.uint64(pow(base, k, 1 << 64))
            _POW[i] = np.concatenate([_POW[i], _POW[i] * step])
    return _POW[0][:n], _POW[1][:n]


def as_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string or binary column; null rows are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each (one long row is a range)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each word."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True  # a row begins: a word can't go on across it
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | first[1 : len(data)]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1 : len(data)]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each span, A-Z folded.  Spans are hashed in pieces of
    the buffer, so working memory stays near 40 bytes a byte of one piece."""
    out = np.empty(len(starts), np.uint64)
    lut, i, piece = _FOLDED if fold else _BYTE, 0, 1 << 21
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + piece, "right")))
        hi = int(ends[j - 1])
        power, inverse = _powers(hi - lo + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(lut[data[lo:hi]] * power[: hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64) * _COEF[63])
        i = j
    return out


def join_hashes(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of an ordered tuple of hashes."""
    total = np.zeros(len(parts[0]), np.uint64)
    for p, c in zip(parts, _COEF, strict=False):
        total += mix(p) * c
    return mix(total)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> Iterator[np.ndarray]:
    """For each row its sorted distinct shingle hashes.

    A row with fewer words than ``size`` has its whole word sequence as the
    one shingle; a row without words has none.
    """
    for lo, hi in blocks(offsets):
        off = offsets[lo : hi + 1] - offsets[lo]
        part = data[offsets[lo] : offsets[hi]]
        starts, ends, _ = words(part, off)
        h = hashes(part, starts, ends)
        at = np.searchsorted(starts, off)  # first word of each row
        grams = join_hashes([h[k : len(h) - size + 1 + k] for k in range(size)]) if len(h) >= size else h[:0]
        for r in range(hi - lo):
            a, b = int(at[r]), int(at[r + 1])
            if b - a >= size:
                yield np.unique(grams[a : b - size + 1])
            elif b > a:
                few = join_hashes([h[k : k + 1] for k in range(a, b)])
                yield mix(few + np.uint64(b - a))
            else:
                yield h[:0]
