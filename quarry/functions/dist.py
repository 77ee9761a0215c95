"""Distribution tails for p-values, as vectorised pandas UDFs.

These run over already aggregated rows (one per test or per comparison),
never over the raw data.  scipy is not assumed; the regularised incomplete
beta and gamma functions are evaluated by their standard continued
fraction / series expansions (Numerical Recipes, ch. 6).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-15
_TINY = 1e-300


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        de = d * c
        h *= de
        if abs(de - 1.0) < _EPS:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    bt = math.exp(lbt)
    if x < (a + 1.0) / (a + b + 2.0):
        return bt * _betacf(a, b, x) / a
    return 1.0 - bt * _betacf(b, a, 1.0 - x) / b


def gammainc_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    gln = math.lgamma(a)
    if x < a + 1.0:
        ap, s, d = a, 1.0 / a, 1.0 / a
        for _ in range(1000):
            ap += 1.0
            d *= x / ap
            s += d
            if abs(d) < abs(s) * _EPS:
                break
        return 1.0 - s * math.exp(-x + a * math.log(x) - gln)
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = _TINY if abs(d) < _TINY else d
        c = b + an / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        de = d * c
        h *= de
        if abs(de - 1.0) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - gln) * h


def t_two_sided(t: float, dof: float) -> float:
    if t is None or dof is None or not np.isfinite(t) or dof <= 0:
        return float("nan")
    return betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def norm_two_sided(z: float) -> float:
    if z is None or not np.isfinite(z):
        return float("nan")
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi2_upper(x: float, k: float) -> float:
    if x is None or k is None or not np.isfinite(x) or k <= 0:
        return float("nan")
    return gammainc_upper(k / 2.0, x / 2.0)


def f_upper(f: float, d1: float, d2: float) -> float:
    if f is None or not np.isfinite(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


@F.pandas_udf(T.DoubleType())
def _t_sf2(t: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(a, b) for a, b in zip(t, d)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _norm_sf2(z: pd.Series) -> pd.Series:
    return pd.Series([norm_two_sided(a) for a in z], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _chi2_sf(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([chi2_upper(a, b) for a, b in zip(x, k)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _f_sf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([f_upper(a, b, c) for a, b, c in zip(f, d1, d2)], dtype="float64")


def t_sf2(t, dof):
    return _t_sf2(t.cast("double"), dof.cast("double"))


def norm_sf2(z):
    return _norm_sf2(z.cast("double"))


def chi2_sf(x, k):
    return _chi2_sf(x.cast("double"), k.cast("double"))


def f_sf(f, d1, d2):
    return _f_sf(f.cast("double"), d1.cast("double"), d2.cast("double"))
