"""Two-sample t-test from summary statistics (pooled variance).

The statistic is column arithmetic. The two-sided p-value needs the regularised
incomplete beta function, the only UDF of the package (Arrow-batched).
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship the functions of this module by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def pooled_t(mean1: Column, sd1: Column, n1: Column, mean2: Column, sd2: Column, n2: Column) -> tuple[Column, Column]:
    """t statistic and degrees of freedom; NULL where the pooled error is zero."""
    n1, n2 = n1.cast("double"), n2.cast("double")
    df = n1 + n2 - 2
    pooled = F.try_divide((n1 - 1) * sd1 * sd1 + (n2 - 1) * sd2 * sd2, df)
    error = F.sqrt(pooled * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    return F.try_divide(mean1 - mean2, error), df


NORMAL_DF = 1e6  # degrees of freedom beyond which the normal form is used


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 20_000):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            c = 1.0 + numerator / c
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = np.where(np.abs(c) < tiny, tiny, c)
            step = c * d
            h = h * step
        if np.all(np.abs(step - 1.0) < 1e-15):
            return h
    # what did not converge is no value
    return np.where(np.abs(step - 1.0) < 1e-15, h, np.nan)


def _log_beta_half(a: float) -> float:
    """log B(a, 1/2); the large-a series avoids cancelling two huge log-gammas."""
    if a > 1e4:
        return 0.5 * math.log(math.pi) - 0.5 * math.log(a) + 1.0 / (8 * a) - 1.0 / (192 * a**3)
    return math.lgamma(a) + 0.5 * math.log(math.pi) - math.lgamma(a + 0.5)


def two_sided_p(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| > |t|) = I_{df/(df+t^2)}(df/2, 1/2); NaN in, NaN out."""
    t, df = np.asarray(t, dtype=float), np.asarray(df, dtype=float)
    out = np.full(t.shape, np.nan)
    ok = np.isfinite(t) & (df > 0)
    if not ok.any():
        return out
    many = ok & (df > NORMAL_DF)
    if many.any():
        # so many degrees of freedom that the transform to a normal variable is exact to the last digits
        nu = df[many]
        z = (8 * nu + 1) / (8 * nu + 3) * np.sqrt(nu * np.log1p(t[many] ** 2 / nu))
        out[many] = [math.erfc(x / math.sqrt(2)) for x in z]
    ok &= ~many
    if not ok.any():
        return out
    tt, nu = t[ok] ** 2, df[ok]
    a, b = nu / 2.0, np.full(nu.shape, 0.5)
    x, y = nu / (nu + tt), tt / (nu + tt)
    log_beta = np.array([_log_beta_half(v) for v in a])
    with np.errstate(divide="ignore"):
        front = np.exp(a * -np.log1p(tt / nu) + b * np.log(y) - log_beta)
    direct = x < (a + 1.0) / (a + b + 2.0)
    p = np.where(
        direct,
        front * _beta_fraction(a, b, np.where(direct, x, 0.5)) / a,
        1.0 - front * _beta_fraction(b, a, np.where(direct, 0.5, y)) / b,
    )
    out[ok] = np.where(tt == 0, 1.0, np.clip(p, 0.0, 1.0))
    return out


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    p = two_sided_p(t.to_numpy(dtype=float, na_value=np.nan), df.to_numpy(dtype=float, na_value=np.nan))
    return pd.Series(p).where(~np.isnan(p), None)
