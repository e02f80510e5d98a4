"""Word and shingle hashes of texts held in Arrow buffers: a few vector operations per document, no Python strings.

A word's hash is the xxhash64 of its UTF-8 bytes; a shingle's is made of those of its words. The same bytes give the same
hash in every process. Polynomials from prefix sums serve the strings of one length that anchors compare.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_POWERS = np.ones(1, dtype=np.uint64)
_INVERSES = np.ones(1, dtype=np.uint64)
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Bytes after the last string, so that eight can be read at any place.
PAD = 8

# xxhash64: fixed values of the published algorithm
P1, P2, P3, P4, P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    step = np.uint64(base)
    while len(out) < n:  # doubling: the powers so far, times the next
        out = np.concatenate([out, out * step])
        step = step * step
    return out


def _tables(n: int):
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        with np.errstate(over="ignore"):
            _POWERS = _powers(_BASE, n)
            _INVERSES = _powers(pow(_BASE, -1, 1 << 64), n)
    return _POWERS, _INVERSES


def mixed(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def lanes(data: np.ndarray, kind: str) -> np.ndarray:
    """An integer read at every byte of `data` (not aligned)."""
    kind = np.dtype(kind)
    return np.ndarray(shape=(len(data) - kind.itemsize + 1,), dtype=kind, buffer=data, strides=(1,))


def xxhash64(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of the strings of `size` bytes at `start`; `data` has PAD bytes after the last string."""
    eight, four = lanes(data, "<u8"), lanes(data, "<u4")
    with np.errstate(over="ignore"):
        h = np.full(len(start), P5)
        at = start.copy()
        left = size.copy()
        long = np.flatnonzero(size >= 32)
        if len(long):
            acc = [np.full(len(long), v, np.uint64) for v in (P1 + P2, P2, np.uint64(0), np.uint64(0) - P1)]
            rows, place, rest = np.arange(len(long)), at[long], left[long]
            while len(rows):
                for k in range(4):
                    acc[k][rows] = _round(acc[k][rows], eight[place[rows] + 8 * k])
                place[rows] += 32
                rest[rows] -= 32
                rows = rows[rest[rows] >= 32]
            merged = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
            for a in acc:
                merged = (merged ^ _round(np.zeros(len(a), np.uint64), a)) * P1 + P4
            h[long], at[long], left[long] = merged, place, rest
        h += size.astype(np.uint64)
        for _ in range(3):
            rows = np.flatnonzero(left >= 8)
            if not len(rows):
                break
            lane = eight[at[rows]]
            h[rows] = _rotl(h[rows] ^ _round(np.zeros(len(rows), np.uint64), lane), 27) * P1 + P4
            at[rows] += 8
            left[rows] -= 8
        rows = np.flatnonzero(left >= 4)
        h[rows] = _rotl(h[rows] ^ (four[at[rows]].astype(np.uint64) * P1), 23) * P2 + P3
        at[rows] += 4
        left[rows] -= 4
        for _ in range(3):
            rows = np.flatnonzero(left > 0)
            if not len(rows):
                break
            h[rows] = _rotl(h[rows] ^ (data[at[rows]].astype(np.uint64) * P5), 11) * P1
            at[rows] += 1
            left[rows] -= 1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        return h ^ (h >> np.uint64(32))


def texts(column):
    """Bytes of each row of an Arrow string column, as views of its buffer (a null is empty)."""
    import pyarrow as pa

    column = column.cast(pa.large_string())
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        _, offsets, data = chunk.buffers()
        if not len(chunk):
            continue
        at = np.frombuffer(offsets, dtype=np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        flat = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        valid = chunk.is_valid().to_numpy(zero_copy_only=False)
        for i in range(len(chunk)):
            yield flat[at[i] : at[i + 1]] if valid[i] else flat[:0]


def word_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of each word, in order; A-Z count as a-z."""
    n = len(text)
    if not n:
        return np.zeros(0, np.uint64)
    edge = np.diff(np.concatenate([[True], BLANK[text], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.zeros(n + PAD, np.uint8)
    padded[:n] = LOWER[text]
    return xxhash64(padded, starts, ends - starts)


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of `size` words; of the whole sequence if it is shorter; of nothing: none."""
    if not len(words):
        return words
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - n + 1 + i]
    return np.unique(mixed(out))
