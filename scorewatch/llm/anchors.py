"""Anchors of a byte text: positions that every long enough string picks from its own bytes alone.

Of all seeds (runs of `SEED` bytes) inside a window of `length` bytes, the one with the smallest hash is the window's
anchor. Equal windows have their anchor at the same place, so two equal windows can only be met at equal seeds that are
anchors: about one position in 85 for 200 bytes, whatever the text.
"""

from __future__ import annotations

import numpy as np

from .hashing import _tables, mixed

SEED = 32
# A text is gone through in pieces of so many window starts; positions inside a piece need 20 bits.
PIECE = (1 << 20) - 4096
_LOW = np.uint64((1 << 20) - 1)


def prefix_sums(text: np.ndarray) -> np.ndarray:
    powers, _ = _tables(len(text) + 1)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers[: len(text)], out=sums[1:])
    return sums


def names(sums: np.ndarray, starts, length) -> np.ndarray:
    """Hashes of the strings of `length` bytes at `starts`."""
    _, inverses = _tables(len(sums))
    return mixed((sums[starts + length] - sums[starts]) * inverses[starts])


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values: the minimum to the end of one block and from the start of the next."""
    n = len(values) - width + 1
    full = -(-len(values) // width) * width
    grid = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    grid[: len(values)] = values
    grid = grid.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def blocks(text: np.ndarray, length: int):
    """(seed name, anchor, first start, last start, block name) arrays per piece of a text; names are 64-bit hashes.

    A block is a run of window starts with one anchor; its name stands for all bytes that its windows cover and for
    where in them the anchor lies.
    """
    total = len(text)
    for begin in range(0, max(0, total - length + 1), PIECE):
        part = text[begin : begin + PIECE + length - 1]
        n = len(part) - length + 1
        sums = prefix_sums(part)
        seeds = names(sums, np.arange(len(part) - SEED + 1), SEED)
        packed = (seeds & ~_LOW) | np.arange(len(seeds), dtype=np.uint64)
        anchor = (_window_minimum(packed, length - SEED + 1) & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.concatenate([first[1:], [n]]) - 1
        anchor = anchor[first]
        whole = names(sums, first, last - first + length)
        place = mixed(np.uint64(0x1000) * (anchor - first).astype(np.uint64) + (last - first).astype(np.uint64))
        yield seeds[anchor], anchor + begin, first + begin, last + begin, mixed(whole ^ place)
