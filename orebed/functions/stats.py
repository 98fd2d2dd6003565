"""Aggregate expressions and small numeric helpers."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def skew_corrected(c: Column) -> Column:
    """Bias-corrected skewness (needs 3 values); 0 for a constant column."""
    n = F.count(c).cast("double")
    g1 = F.coalesce(F.nanvl(F.skewness(c), F.lit(0.0)), F.lit(0.0))
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def kurt_corrected(c: Column) -> Column:
    """Unbiased excess kurtosis (needs 4 values); 0 for a constant column."""
    n = F.count(c).cast("double")
    raw = F.kurtosis(c)
    g2 = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * raw + 6)
    constant = raw.isNull() | F.isnan(raw)
    return F.when(n >= 4, F.when(constant, F.lit(0.0)).otherwise(g2))


def null_share(c: Column) -> Column:
    return F.avg(c.isNull().cast("double"))


def pairs_of(n: Column) -> Column:
    """Number of unordered pairs among n things."""
    n = n.cast("double")
    return n * (n - 1) / 2.0


def digamma_values(x: np.ndarray) -> np.ndarray:
    """Digamma of numbers >= 1 in a task, as ``columns.digamma`` computes it."""
    x = np.asarray(x, dtype=float)
    z = x + 8.0
    inv2 = 1.0 / (z * z)
    out = np.log(z) - 0.5 / z - inv2 * (1.0 / 12 - inv2 * (1.0 / 120 - inv2 * (1.0 / 252 - inv2 / 240.0)))
    for i in range(8):
        out -= 1.0 / (x + i)
    return out


def gamma_p(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return total * front
    # Lentz evaluation of the continued fraction for the upper part
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return 1 - front * h


def chi2_quantile(q: float, dof: int) -> float:
    """Quantile of the chi-square distribution, by bisection."""
    lo, hi = 0.0, float(dof)
    while gamma_p(dof / 2, hi / 2) < q:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if gamma_p(dof / 2, mid / 2) < q:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2
