"""Tail areas and quantiles of the t, F and normal distributions.

The array functions work on numpy arrays, so one call serves a coefficient
table on the driver and a batch of groups inside a pandas UDF alike.
"""

from __future__ import annotations

import functools
import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

_FRACTION_STEPS = 300
_FRACTION_TOLERANCE = 1e-15
_TINY = 1e-300


_LARGE = 1e5  # beyond this, differences of log-gamma lose too many digits


def _each(function, x) -> np.ndarray:
    """A scalar function of the math module over an array."""
    x = np.asarray(x, dtype=float)
    return np.array([function(v) for v in x.ravel()]).reshape(x.shape)


def _log_beta(a, b):
    exact = _each(math.lgamma, a) + _each(math.lgamma, b) - _each(math.lgamma, a + b)
    big, small = np.maximum(a, b), np.minimum(a, b)
    limit = _each(math.lgamma, small) - small * np.log(big)
    limit = limit - small * (small - 1.0) / (2.0 * big)
    return np.where((big > _LARGE) & (small < 1e-3 * big), limit, exact)


def _beta_fraction(x, a, b):
    """Continued fraction of the incomplete beta integral, by Lentz's method."""

    def nonzero(v):
        return np.where(np.abs(v) < _TINY, _TINY, v)

    c = np.ones_like(x)
    d = 1.0 / nonzero(1.0 - (a + b) * x / (a + 1.0))
    value = d.copy()
    for m in range(1, _FRACTION_STEPS):
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        for term in (even, odd):
            d = 1.0 / nonzero(1.0 + term * d)
            c = nonzero(1.0 + term / c)
            value = value * d * c
        if np.all(np.abs(d * c - 1.0) < _FRACTION_TOLERANCE):
            break
    return value


def incomplete_beta(x, a, b):
    """Regularised incomplete beta I_x(a, b), elementwise."""
    x, a, b = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (x, a, b)))
    x = np.clip(x, 0.0, 1.0)
    inside = np.clip(x, _TINY, 1.0 - 1e-16)
    front = np.exp(a * np.log(inside) + b * np.log1p(-inside) - _log_beta(a, b))
    direct = inside < (a + 1.0) / (a + b + 2.0)
    low = front * _beta_fraction(np.where(direct, inside, 0.5), a, b) / a
    high = 1.0 - front * _beta_fraction(np.where(direct, 0.5, 1.0 - inside), b, a) / b
    out = np.where(direct, low, high)
    return np.where(x <= 0.0, 0.0, np.where(x >= 1.0, 1.0, out))


def t_two_sided(t, df):
    """P(|T| > |t|) for Student's t."""
    t = np.abs(np.asarray(t, dtype=float))
    df = np.asarray(df, dtype=float)
    z = t * (1.0 - 0.25 / df) / np.sqrt(1.0 + t * t / (2.0 * df))
    limit = _each(math.erfc, z / math.sqrt(2.0))
    return np.where(df > _LARGE, limit, incomplete_beta(df / (df + t * t), df / 2.0, 0.5))


def f_upper(f, df1, df2):
    """P(F > f) for the F distribution."""
    f = np.maximum(np.asarray(f, dtype=float), 0.0)
    df1, df2 = float(df1), float(df2)
    return incomplete_beta(df2 / (df2 + df1 * f), df2 / 2.0, df1 / 2.0)


def t_quantiles(p: float, df) -> np.ndarray:
    """Upper quantiles (p > 1/2) for many degrees of freedom, by bisection."""
    df = np.asarray(df, dtype=float)
    target = 2.0 * (1.0 - p)
    low, high = np.zeros_like(df), np.ones_like(df)
    while True:
        short = t_two_sided(high, df) > target
        if not short.any():
            break
        low, high = np.where(short, high, low), np.where(short, 2.0 * high, high)
    for _ in range(60):
        middle = 0.5 * (low + high)
        above = t_two_sided(middle, df) > target
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return 0.5 * (low + high)


@lru_cache(maxsize=1024)
def t_quantile(p: float, df: float) -> float:
    """The value with probability ``p`` below it."""
    if p == 0.5:
        return 0.0
    if p < 0.5:
        return -t_quantile(1.0 - p, df)
    return float(t_quantiles(p, np.array([df]))[0])


def normal_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def normal_quantile(p: float) -> float:
    """Inverse normal distribution function of a single probability."""
    from statistics import NormalDist

    return NormalDist().inv_cdf(p)


@F.pandas_udf(T.DoubleType())
def t_two_sided_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    known = t.notna() & (df > 0)
    tail = t_two_sided(t.where(known, 0.0), df.where(known, 1.0))
    return pd.Series(tail, index=t.index).where(known)


# fixed values: numerators and denominators of Wichura's approximations (Applied Statistics 37, 1988, algorithm 241),
# highest power first: in the middle, in the tails, and far out
_MIDDLE, _TAIL, _FAR = (
    ((2509.0809287301227, 33430.57558358813, 67265.7709270087, 45921.95393154987, 13731.69376550946, 1971.5909503065513, 133.14166789178438, 3.3871328727963665),
     (5226.495278852854, 28729.085735721943, 39307.89580009271, 21213.794301586597, 5394.196021424751, 687.1870074920579, 42.31333070160091, 1.0)),
    ((0.0007745450142783414, 0.022723844989269184, 0.2417807251774506, 1.2704582524523684, 3.6478483247632045, 5.769497221460691, 4.630337846156546, 1.4234371107496835),
     (1.0507500716444169e-09, 0.0005475938084995345, 0.015198666563616457, 0.14810397642748008, 0.6897673349851, 1.6763848301838038, 2.053191626637759, 1.0)),
    ((2.0103343992922881e-07, 2.7115555687434876e-05, 0.0012426609473880784, 0.026532189526576124, 0.29656057182850487, 1.7848265399172913, 5.463784911164114, 6.657904643501103),
     (2.0442631033899397e-15, 1.421511758316446e-07, 1.8463183175100548e-05, 0.0007868691311456133, 0.014875361290850615, 0.1369298809227358, 0.599832206555888, 1.0)),
)


def normal_quantile_of(p, sqrt, log, choose):
    """The normal quantile of ``p`` as an expression of whatever ``sqrt``, ``log`` and ``choose(condition, a, b)`` build."""

    def ratio(which, r):
        top, bottom = (functools.reduce(lambda total, c: total * r + c, side[1:], side[0]) for side in which)
        return top / bottom

    q = p - 0.5
    middle = ratio(_MIDDLE, 0.180625 - q * q) * q
    r = sqrt(-log(choose(q <= 0, p, 1.0 - p)))
    outside = choose(r <= 5, ratio(_TAIL, r - 1.6), ratio(_FAR, r - 5.0))
    return choose((q <= 0.425) & (q >= -0.425), middle, choose(q < 0, -outside, outside))


def normal_quantile_column(p: Column) -> Column:
    """The normal quantile in the JVM; missing outside of (0, 1)."""
    inside = F.when((p > 0) & (p < 1), p)
    return normal_quantile_of(inside, F.sqrt, F.log, lambda condition, a, b: F.when(condition, a).otherwise(b))


def guarded(expr: Column, condition: Column) -> Column:
    """``expr`` where ``condition`` holds, else NULL: no NaN or infinity leaves a query."""
    return F.when(condition, expr)
