import itertools
import math

import pytest

from tallyforge.functions import stats


@pytest.mark.parametrize("x,dof,p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (18.307038, 10, 0.05), (6.634897, 1, 0.01), (0.0, 3, 1.0)])
def test_chi_square_table(x, dof, p):
    assert stats.chi_square_p(x, dof) == pytest.approx(p, abs=1e-6)


@pytest.mark.parametrize("t,p", [(1.2238, 0.10), (1.3581, 0.05), (1.6276, 0.01), (0.5, 0.9639)])
def test_kolmogorov_table(t, p):
    assert stats.kolmogorov_tail(t) == pytest.approx(p, abs=2e-4)


def test_kolmogorov_forms_agree():
    assert stats.kolmogorov_tail(0.9999999) == pytest.approx(stats.kolmogorov_tail(1.0000001), abs=1e-6)


def _by_hand(d, m, n):
    hits = 0
    for ups in itertools.combinations(range(m + n), m):
        i = j = 0
        out = False
        for s in range(m + n):
            i, j = (i + 1, j) if s in ups else (i, j + 1)
            out |= abs(i / m - j / n) >= d - 1e-12
        hits += out
    return hits / math.comb(m + n, m)


@pytest.mark.parametrize("d,m,n", [(0.8, 5, 5), (0.6, 5, 5), (0.5, 4, 6), (2 / 3, 3, 6), (0.35, 4, 5)])
def test_exact_two_sample_by_enumeration(d, m, n):
    assert stats.ks_two_sample_p(d, m, n, "exact") == pytest.approx(_by_hand(d, m, n), abs=1e-12)


def test_exact_two_sample_published_value():
    assert stats.ks_two_sample_p(0.6, 10, 10, "exact") == pytest.approx(0.052448, abs=1e-6)


def test_asymptotic_meets_exact():
    exact = stats.ks_two_sample_p(0.06, 1500, 1700, "exact")
    assert stats.ks_two_sample_p(0.06, 1500, 1700) == pytest.approx(exact, rel=0.05)
