"""Tail probabilities for a handful of aggregated rows (the p-values of the tests)."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship this module's functions with the tasks, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 2000):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return value


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float, df: float) -> float:
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


def f_upper(f: float, df1: float, df2: float) -> float:
    return beta_inc(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * f)) if f > 0 else 1.0


def chi2_upper(x: float, df: float) -> float:
    """Upper tail of chi-square by the incomplete gamma series or fraction."""
    a, x = df / 2.0, x / 2.0
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1.0
            term *= x / k
            total += term
        return 1.0 - front * total
    b = x + 1.0 - a
    c, d = 1e300, 1.0 / b
    value = d
    for i in range(1, 2000):
        an = -i * (i - a)
        b += 2.0
        d = 1.0 / (an * d + b)
        c = b + an / c
        value *= d * c
        if abs(d * c - 1.0) < 1e-16:
            break
    return front * value


def _bisect(tail, target: float) -> float:
    """The point where a decreasing upper tail falls to ``target``."""
    low, high = 0.0, 1.0
    while tail(high) > target:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        low, high = (mid, high) if tail(mid) > target else (low, mid)
    return (low + high) / 2.0


def t_critical(df: float, level: float = 0.95) -> float:
    return _bisect(lambda t: t_two_sided(t, df), 1.0 - level)


def beta_quantile(a: float, b: float, level: float) -> float:
    """The point at which the incomplete beta function reaches a level."""
    low, high = 0.0, 1.0
    for _ in range(100):
        mid = (low + high) / 2.0
        low, high = (mid, high) if beta_inc(a, b, mid) < level else (low, mid)
    return (low + high) / 2.0


def binomial_interval(hits: float, n: float, level: float = 0.95) -> tuple[float, float]:
    """Exact limits of a share: each tail of the binomial has half of what is left."""
    tail = (1.0 - level) / 2.0
    low = beta_quantile(hits, n - hits + 1, tail) if hits > 0 else 0.0
    return low, beta_quantile(hits + 1, n - hits, 1.0 - tail) if hits < n else 1.0


def binomial_upper(hits: float, n: float, p: float) -> float:
    """The chance of so many hits or more."""
    return beta_inc(hits, n - hits + 1, p) if hits > 0 else 1.0


_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(96)
_ERF = np.vectorize(math.erf)


def _normal_cdf(z):
    return 0.5 * (1.0 + _ERF(z / math.sqrt(2.0)))


def _range_cdf(w: np.ndarray, k: int) -> np.ndarray:
    """CDF of the range of k standard normals at each w."""
    z = 8.0 * _NODES
    density = np.exp(-z * z / 2.0) / math.sqrt(2.0 * math.pi) * 8.0 * _WEIGHTS
    inner = (_normal_cdf(z)[None, :] - _normal_cdf(z[None, :] - w[:, None])) ** (k - 1)
    return np.minimum(1.0, k * (inner * density[None, :]).sum(axis=1))


def tukey_upper(q: float, k: int, df: float) -> float:
    """Upper tail of the studentised range, by quadrature over the scale s."""
    if q <= 0:
        return 1.0
    spread = 8.0 / math.sqrt(2.0 * df)
    low, high = max(1e-9, 1.0 - spread), 1.0 + spread
    s = (high - low) / 2.0 * _NODES + (high + low) / 2.0
    log_density = (
        math.log(2.0) + df / 2.0 * math.log(df / 2.0) - math.lgamma(df / 2.0) + (df - 1.0) * np.log(s) - df * s * s / 2.0
    )
    weight = np.exp(log_density) * _WEIGHTS * (high - low) / 2.0
    return float(min(1.0, max(0.0, 1.0 - (weight * _range_cdf(q * s, k)).sum() / weight.sum())))


def tukey_critical(k: int, df: float, level: float = 0.95) -> float:
    return _bisect(lambda q: tukey_upper(q, k, df), 1.0 - level)


def _each(function, *series: pd.Series) -> pd.Series:
    return pd.Series(
        [
            None if any(pd.isna(v) for v in row) or row[-1] <= 0 else function(*map(float, row))
            for row in zip(*series, strict=True)
        ],
        dtype="float64",
    )


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return _each(t_two_sided, t, df)


@F.pandas_udf(T.DoubleType())
def t_quantile95(df: pd.Series) -> pd.Series:
    return _each(t_critical, df)


@F.pandas_udf(T.DoubleType())
def t_quantile(level: pd.Series, df: pd.Series) -> pd.Series:
    """The point beyond which, on both sides, 1 - level is left."""
    return _each(lambda p, n: t_critical(n, p), level, df)


@F.pandas_udf(T.DoubleType())
def f_pvalue(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return _each(f_upper, f, df1, df2)


@F.pandas_udf(T.DoubleType())
def tukey_pvalue(q: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    return _each(lambda a, b, c: tukey_upper(a, int(b), c), q, k, df)


@F.pandas_udf(T.DoubleType())
def tukey_quantile95(k: pd.Series, df: pd.Series) -> pd.Series:
    levels = {}
    pairs = list(zip(k, df, strict=True))
    for pair in set(pairs):
        levels[pair] = tukey_critical(int(pair[0]), float(pair[1])) if pair[1] > 0 else None
    return pd.Series([levels[p] for p in pairs], dtype="float64")


@F.pandas_udf(T.StructType([T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType())]))
def binomial_interval95(hits: pd.Series, n: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([binomial_interval(float(k), float(m)) for k, m in zip(hits, n, strict=True)], columns=["low", "high"])


@F.pandas_udf(T.DoubleType())
def binomial_pvalue(hits: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    return pd.Series([binomial_upper(float(k), float(m), float(q)) for k, m, q in zip(hits, n, p, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(x: pd.Series, df: pd.Series) -> pd.Series:
    return _each(chi2_upper, x, df)
