"""Tail probabilities of a few distributions, applied to one-row results of Spark aggregates."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def gamma_tail(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function: series below a+1, continued fraction above."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - front * total)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or tiny)
        c = b + an / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def chi2_tail(x: float, freedom: float) -> float:
    return gamma_tail(freedom / 2, x / 2)


def beta_ratio(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_ratio(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or tiny)
    h = d
    for m in range(1, 10_000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + term * d or tiny)
            c = 1 + term / c or tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def student_two_sided(t: float, freedom: float) -> float:
    return beta_ratio(freedom / 2, 0.5, freedom / (freedom + t * t))


def f_tail(f: float, d1: float, d2: float) -> float:
    return beta_ratio(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def _columnwise(fn):
    @F.pandas_udf(T.DoubleType())
    def apply(*args: pd.Series) -> pd.Series:
        return pd.Series([None if any(pd.isna(v) for v in row) else float(fn(*row)) for row in zip(*args)], dtype="float64")

    return apply


normal_p = _columnwise(normal_two_sided)
chi2_p = _columnwise(chi2_tail)
student_p = _columnwise(student_two_sided)
f_p = _columnwise(f_tail)
