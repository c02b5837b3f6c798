"""p-value helpers for test statistics that Spark computes in SQL.

Only the last step (statistic -> p) runs in Python, as Arrow-batched pandas
UDFs over result rows (one row per tested column): the data-sized work is
always the Spark aggregate that produced the statistic.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def norm_sf(z: float) -> float:
    """Upper tail of the standard normal."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _gamma_p_series(a: float, x: float) -> float:
    term = total = 1.0 / a
    ap = a
    for _ in range(10000):
        ap += 1.0
        term *= x / ap
        total += term
        if abs(term) < abs(total) * 1e-16:
            break
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gamma_q_fraction(a: float, x: float) -> float:
    # modified Lentz evaluation of the continued fraction for Q(a, x)
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-16:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def gamma_q(a: float, x: float) -> float:
    """Regularized upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        return 1.0 - _gamma_p_series(a, x)
    return _gamma_q_fraction(a, x)


def chi2_sf(x: float, dof: float) -> float:
    """Survival function of the chi-square distribution."""
    if x is None or dof is None or dof <= 0 or math.isnan(x):
        return float("nan")
    return gamma_q(dof / 2.0, x / 2.0)


def ks_sf(d: float, n_eff: float) -> float:
    """Asymptotic two-sample Kolmogorov-Smirnov p (Kolmogorov distribution)."""
    if n_eff <= 0:
        return float("nan")
    lam = (math.sqrt(n_eff) + 0.12 + 0.11 / math.sqrt(n_eff)) * d
    if lam < 0.05:
        return 1.0  # 1 - p is under exp(-490)
    if lam < 1.18:  # the theta form converges fast where the alternating series does not
        y = math.exp(-math.pi ** 2 / (8.0 * lam * lam))
        cdf = math.sqrt(2.0 * math.pi) / lam * sum(y ** ((2 * j - 1) ** 2) for j in range(1, 6))
        return min(max(1.0 - cdf, 0.0), 1.0)
    s = 0.0
    for j in range(1, 101):
        t = 2.0 * (-1) ** (j - 1) * math.exp(-2.0 * j * j * lam * lam)
        s += t
        if abs(t) < 1e-12:
            break
    return min(max(s, 0.0), 1.0)


@F.pandas_udf(T.DoubleType())
def _norm_two_sided(z: pd.Series) -> pd.Series:
    return z.map(lambda v: float("nan") if pd.isna(v) else 2.0 * norm_sf(abs(v)))


@F.pandas_udf(T.DoubleType())
def _chi2_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([float("nan") if pd.isna(a) or pd.isna(b) else chi2_sf(float(a), float(b))
                      for a, b in zip(x, dof)])


@F.pandas_udf(T.DoubleType())
def _ks_p(d: pd.Series, n_eff: pd.Series) -> pd.Series:
    return pd.Series([float("nan") if pd.isna(a) or pd.isna(b) else ks_sf(float(a), float(b))
                      for a, b in zip(d, n_eff)])


def two_sided_normal_p(z: Column) -> Column:
    return _norm_two_sided(z.cast("double"))


def chi2_p(x: Column, dof: Column) -> Column:
    return _chi2_p(x.cast("double"), dof.cast("double"))


def ks_p(d: Column, n_eff: Column) -> Column:
    return _ks_p(d.cast("double"), n_eff.cast("double"))
