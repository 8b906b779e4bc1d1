"""Scalar statistics on the driver: p-values of a handful of already aggregated numbers."""
from __future__ import annotations

import math

import numpy as np


def gamma_upper(a, x):
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - front * total)
    # continued fraction, evaluated with the modified Lentz scheme
    tiny = 1e-300
    b = x + 1 - a
    c_, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c_ = b + an / c_
        c_ = c_ if abs(c_) > tiny else tiny
        step = c_ * d
        h *= step
        if abs(step - 1) < 1e-16:
            break
    return front * h


def chi_square_p(statistic, dof):
    """Chance of a larger chi-square value; 1 when there is nothing to compare."""
    return 1.0 if dof <= 0 else gamma_upper(dof / 2.0, statistic / 2.0)


def kolmogorov_tail(t):
    """P(K > t) of the limiting Kolmogorov distribution."""
    if t <= 0:
        return 1.0
    if t < 1.0:  # the theta-function form converges fast for small t
        terms = (math.exp(-((2 * k - 1) ** 2) * math.pi**2 / (8 * t * t)) for k in range(1, 20))
        return 1.0 - math.sqrt(2 * math.pi) / t * sum(terms)
    return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * t * t) for k in range(1, 101))))


def _ks_exact(d, m, n):
    """Chance that a random path from (0, 0) to (m, n) leaves the band of width ``d``."""
    g = math.gcd(m, n)
    mg, ng = m // g, n // g
    reach = round(d * mg * ng * g)
    if reach <= 0:
        return 1.0
    # leave[i]: chance that a path through (i, s - i) has left the band by then; it is 1 outside
    # the band, and only the cells inside it are updated from one diagonal to the next
    leave = np.ones(m + 2)
    old_low, old_high = 0, 0
    leave[1] = 0.0  # cell i is kept at i + 1
    for s in range(1, m + n + 1):
        low = max(0, s - n, (s * mg - reach) // (mg + ng) + 1)
        high = min(m, s, -((-s * mg - reach) // (mg + ng)) - 1)
        if low > high:
            return 1.0
        i = np.arange(low, high + 1)
        new = (leave[low : high + 1] * i + leave[low + 1 : high + 2] * (s - i)) / s
        leave[old_low + 1 : old_high + 2] = 1.0
        leave[low + 1 : high + 2] = new
        old_low, old_high = low, high
    return float(min(1.0, leave[m + 1]))


def ks_two_sample_p(d, n1, n2, method="asymptotic"):
    """Two-sided p-value by one method for every size: ``asymptotic``, or ``exact`` (n1 + n2 steps on the driver)."""
    if method not in ("asymptotic", "exact"):
        raise ValueError(f"unknown method: {method}")
    if d <= 0:
        return 1.0
    if method == "exact":
        return _ks_exact(d, int(n1), int(n2))
    n = n1 * n2 / (n1 + n2)
    root = math.sqrt(n)
    t = root * d
    # small-sample correction of the limiting law (Vrbik 2018)
    return kolmogorov_tail(t + 1 / (6 * root) + (t - 1) / (4 * n))
