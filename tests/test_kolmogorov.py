import math

import numpy as np
import pytest

from scorewatch.functions import kolmogorov

# Published two-sample values for 200 against 200 rows. Fixed values.
GOLDEN = {
    0.26: 1.88192043e-06,
    0.20: 5.551927e-04,
    0.165: 7.568115e-03,
    0.09: 0.370632,
    0.08: 0.518219,
    0.07: 0.684671,
    0.06: 0.842885,
    0.055: 0.906357,
    0.005: 1.0,
}


@pytest.mark.parametrize("d,p", GOLDEN.items())
def test_golden_values(d, p):
    assert kolmogorov.survival(d, 100) == pytest.approx(p, rel=1e-6)


def test_regimes_agree():
    for n in (500, 2000):
        for z in (0.5, 0.8, 1.0, 1.3):
            d = z / math.sqrt(n)
            assert kolmogorov._matrix_cdf(n, d) == pytest.approx(kolmogorov._expansion_cdf(n, d), abs=1e-6)
        d = 1.48 / math.sqrt(n)
        assert 1 - kolmogorov._matrix_cdf(n, d) == pytest.approx(2 * kolmogorov._one_sided_tail(n, d), rel=3e-6)


@pytest.mark.parametrize("n", [30_000, 300_000, 50_000_000])
def test_large_samples_follow_the_limit_law(n):
    for z in (0.6, 1.0, 1.6, 2.5):
        k = np.arange(1, 100)
        limit = 2 * ((-1.0) ** (k - 1) * np.exp(-2 * k**2 * z**2)).sum()
        assert kolmogorov.survival(z / math.sqrt(n), n) == pytest.approx(limit, rel=4 / math.sqrt(n) * z * 2, abs=1e-9)


def test_ends():
    assert kolmogorov.survival(0.0, 100) == 1.0
    assert kolmogorov.survival(1.0, 100) == 0.0
    assert kolmogorov.survival(0.5, 10_000_000) == 0.0
    assert kolmogorov.survival(0.3, 0) == 1.0
