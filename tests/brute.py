"""Plain numpy versions of the statistics, for small frames only."""

import numpy as np


def psi(train, current, buckets=10):
    train, current = np.asarray(train, float), np.asarray(current, float)
    if len(train) == 0 or len(current) == 0:
        return 0.0
    low, high = min(train.min(), current.min()), max(train.max(), current.max())
    if low == high:
        return 0.0
    if len(set(train)) == 1 and len(set(current)) == 1:
        return 1.0
    edges = np.unique(np.quantile(train, np.linspace(0, 1, buckets + 1)))
    inner = edges[1:-1] if len(edges) > 2 else np.linspace(low, high, buckets + 1)[1:-1]
    t = np.bincount(np.searchsorted(inner, train, side="right"), minlength=len(inner) + 1) / len(train)
    c = np.bincount(np.searchsorted(inner, current, side="right"), minlength=len(inner) + 1) / len(current)
    t, c = np.maximum(t, 1e-6), np.maximum(c, 1e-6)
    return float(((c - t) * np.log(c / t)).sum())


def ks_and_wasserstein(train, current):
    grid = np.unique(np.concatenate([train, current]))
    gap = np.abs(
        np.searchsorted(np.sort(train), grid, side="right") / len(train)
        - np.searchsorted(np.sort(current), grid, side="right") / len(current)
    )
    return float(gap.max()), float((gap[:-1] * np.diff(grid)).sum())


def deciles(rows, k=10):
    """rows of (score, entity, label) -> {decile: (count, positives)}; ties by entity, positives first."""
    ordered = sorted(rows, key=lambda r: (-r[0], r[1], -r[2]))
    n = len(ordered)
    k = max(1, min(k, n))
    out = {}
    for i, (_, _, y) in enumerate(ordered):
        d = i * k // n + 1
        c, p = out.get(d, (0, 0))
        out[d] = (c + 1, p + y)
    return out
