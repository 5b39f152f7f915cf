"""Tails and quantiles of the distributions that the operators' tests need."""

from __future__ import annotations

import math


def normal_tail(z: float) -> float:
    """Both tails of the standard normal distribution beyond |z|."""
    return math.erfc(abs(z) / math.sqrt(2))


def chi2_tail(x: float, dof: int) -> float:
    """Upper tail of the chi-squared distribution, by the closed sums for whole degrees of freedom."""
    half = max(0.0, x) / 2
    if dof % 2:
        p, term, k = math.erfc(math.sqrt(half)), math.sqrt(half / math.pi) * 2 * math.exp(-half), 1
        while k < dof:
            p += term
            k += 2
            term *= x / k
    else:
        p, term = 0.0, math.exp(-half)
        for k in range(dof // 2):
            p += term
            term *= half / (k + 1)
    return min(1.0, p)


def chi2_quantile(share: float, dof: int) -> float:
    """x below which the chi-squared distribution has this share, by bisection."""
    low, high = 0.0, 10.0 * dof + 200
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - chi2_tail(mid, dof) < share else (low, mid)
    return low
