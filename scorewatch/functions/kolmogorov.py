"""Survival function of the exact one-sample two-sided Kolmogorov statistic.

Two-sample p-values use it at the effective size n = round(n1 * n2 / (n1 + n2)). The three regimes follow
Simard and L'Ecuyer, "Computing the two-sided Kolmogorov-Smirnov distribution" (2011): a matrix power for
small n (Marsaglia, Tsang, Wang 2003), twice the one-sided tail where it is exact to double precision, and the
Pelz-Good (1976) expansion for large n. It only ever sees one value per reviewed feature.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# ship the kernel with the task, so executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Regime borders of the published algorithm. Fixed values.
MATRIX_MAX_N = 140
SUM_MAX_N = 1_000_000


def _one_sided_tail(n: int, d: float) -> float:
    """P(D+ >= d): Smirnov's finite sum in log space, or its exponential form for very large n."""
    if n > SUM_MAX_N:
        return math.exp(-((6.0 * n * d + 1.0) ** 2) / (18.0 * n))
    j = np.arange(0, int(math.floor(n * (1.0 - d))) + 1, dtype=float)
    rest = 1.0 - d - j / n
    j, rest = j[rest > 0], rest[rest > 0]
    steps = np.concatenate(([0.0], np.log((n - j[:-1]) / (j[:-1] + 1.0))))  # log C(n, j) by ratios
    logs = np.cumsum(steps) + (j - 1.0) * np.log(d + j / n) + (n - j) * np.log(rest)
    return float(d * np.exp(logs).sum())


def _matrix_cdf(n: int, d: float) -> float:
    """P(D < d) from the n-th power of the Marsaglia-Tsang-Wang transition matrix."""
    k = int(n * d) + 1
    m = 2 * k - 1
    h = k - n * d
    order = np.arange(m)
    gap = order[:, None] - order[None, :] + 1
    step = np.where(gap >= 0, 1.0, 0.0)
    powers = h ** np.arange(1, m + 1)
    step[:, 0] -= powers
    step[m - 1, :] -= powers[::-1]
    step[m - 1, 0] += max(0.0, 2.0 * h - 1.0) ** m
    log_fact = np.cumsum(np.concatenate(([0.0], np.log(np.arange(1, m + 1)))))
    step /= np.exp(log_fact[np.maximum(gap, 0)])
    power, log_power = np.eye(m), 0.0
    square, log_square = step, 0.0
    bits = n
    while bits:
        if bits & 1:
            power, log_power = power @ square, log_power + log_square
            top = power.max()
            power, log_power = power / top, log_power + math.log(top)
        square, log_square = square @ square, 2.0 * log_square
        top = square.max()
        square, log_square = square / top, log_square + math.log(top)
        bits >>= 1
    log_ways = math.lgamma(n + 1.0) - n * math.log(n)  # n! / n^n
    return float(power[k - 1, k - 1] * math.exp(log_power + log_ways))


def _expansion_cdf(n: int, d: float) -> float:
    """P(D < d) from the limit law and its first three corrections in 1 / sqrt(n)."""
    z = d * math.sqrt(n)
    z2, pi2 = z * z, math.pi**2
    half = (np.arange(-30, 30) + 0.5) ** 2
    whole = np.arange(-30, 31, dtype=float) ** 2
    at_half = np.exp(-pi2 * half / (2.0 * z2))
    at_whole = np.exp(-pi2 * whole / (2.0 * z2))
    root = math.sqrt(math.pi / 2.0)
    k0 = math.sqrt(2.0 * math.pi) / z * at_half[half.size // 2 :].sum()
    k1 = root / (6.0 * z**4) * ((pi2 * half - z2) * at_half).sum()
    k2 = root / (72.0 * z**7) * (
        (6 * z**6 + 2 * z**4 + pi2 * (2 * z**4 - 5 * z2) * half + pi2**2 * (1 - 2 * z2) * half**2) * at_half
    ).sum() - root / (36.0 * z**3) * (pi2 * whole * at_whole).sum()
    k3 = root / (6480.0 * z**10) * (
        (
            pi2**3 * half**3 * (5 - 30 * z2)
            + pi2**2 * half**2 * (-60 * z2 + 212 * z**4)
            + pi2 * half * (135 * z**4 - 96 * z**6)
            - (30 * z**6 + 90 * z**8)
        )
        * at_half
    ).sum() + root / (108.0 * z**6) * ((-(pi2**2) * whole**2 + 3 * pi2 * whole * z2) * at_whole).sum()
    return float(k0 + k1 / n**0.5 + k2 / n + k3 / n**1.5)


def survival(d: float, n: int) -> float:
    """P(D_n >= d) for sample size n."""
    if n <= 0 or not d > 0.0 or 2.0 * n * d <= 1.0:
        return 1.0
    if d >= 1.0:
        return 0.0
    spread = n * d * d
    if spread >= 370.0:
        return 0.0
    # beyond this spread both tails crossing at once is negligible (below 2e-6 of the result)
    if spread >= (4.0 if n <= MATRIX_MAX_N else 2.2) or d >= 0.5:
        p = 2.0 * _one_sided_tail(n, d)
    elif n <= MATRIX_MAX_N or (n <= 100_000 and n * d**1.5 <= 1.4):
        p = 1.0 - _matrix_cdf(n, d)
    else:
        p = 1.0 - _expansion_cdf(n, d)
    return min(1.0, max(0.0, p))


def ks_pvalue(statistic: Column, n_train: Column, n_current: Column) -> Column:
    """Two-sample p-value column; runs on one row per feature, after all aggregation."""

    @F.pandas_udf("double")
    def pvalue(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
        return pd.Series(
            [
                1.0 if a == 0 or b == 0 else survival(float(x), int(round(float(a) * float(b) / float(a + b))))
                for x, a, b in zip(d, n1, n2)
            ]
        )

    return pvalue(statistic, n_train, n_current)
