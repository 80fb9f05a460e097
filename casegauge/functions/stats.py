"""Numeric helper Spark has no built-in for."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F


def _beta_fraction(a: np.ndarray, b, x: np.ndarray, steps: int = 300) -> np.ndarray:
    """Continued fraction of the regularised incomplete beta function (modified Lentz method)."""
    tiny = 1e-300
    fix = lambda v: np.where(np.abs(v) < tiny, tiny, v)
    c, d = np.ones_like(x), 1.0 / fix(1.0 - (a + b) * x / (a + 1.0))
    out = d.copy()
    for m in range(1, steps):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / fix(1.0 + num * d)
            c = fix(1.0 + num / c)
            out = out * d * c
    return out


def beta_half(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """I_x(a, 1/2)."""
    a, x = np.asarray(a, float), np.clip(np.asarray(x, float), 0.0, 1.0)
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    inner = np.clip(x, 1e-300, 1 - 1e-16)
    front = np.exp(lgamma(a + 0.5) - lgamma(a) - math.lgamma(0.5) + a * np.log(inner) + 0.5 * np.log1p(-inner))
    direct = front * _beta_fraction(a, 0.5, inner) / a
    other = 1.0 - front * _beta_fraction(np.full_like(a, 0.5), a, 1.0 - inner) / 0.5
    out = np.where(inner < (a + 1.0) / (a + 2.5), direct, other)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, out))


def correlation_p_value(r, n) -> Column:
    """Two-sided p-value of Pearson's r over n points. Runs on one row per group, after aggregation."""

    @F.pandas_udf("double")
    def p_value(r: pd.Series, n: pd.Series) -> pd.Series:
        dof = n.to_numpy(float) - 2
        rr = r.to_numpy(float)
        ok = (dof > 0) & ~np.isnan(rr)
        p = beta_half(np.where(ok, dof, 1.0) / 2, 1 - np.where(ok, rr, 0.0) ** 2)
        return pd.Series(np.where(ok, p, np.nan))

    return p_value(r, n)
