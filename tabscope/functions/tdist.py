"""Two-sided p-value of Student's t, for the few rows of a per-feature result table."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tabscope.session import ship


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 100_000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def _gamma_step(a: float) -> float:
    """lgamma(a + 1/2) - lgamma(a), by Stirling's series after shifting ``a`` up, without cancellation."""
    shift = 0.0
    while a < 20.0:
        shift += math.log(a) - math.log(a + 0.5)
        a += 1.0

    def tail(z: float) -> float:
        return 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)

    return shift + a * math.log1p(0.5 / a) - 0.5 + 0.5 * math.log(a) + tail(a + 0.5) - tail(a)


def two_sided_p(t: float, df: float) -> float:
    """P(|T| >= |t|) with ``df`` degrees of freedom; NaN when undefined."""
    if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
        return math.nan
    if math.isinf(t):
        return 0.0
    a, b, x, y = df / 2.0, 0.5, df / (df + t * t), t * t / (df + t * t)
    if x <= 0.0 or y <= 0.0:
        return 0.0 if x <= 0.0 else 1.0
    log_beta = math.lgamma(b) - _gamma_step(a)
    front = math.exp(-a * math.log1p(t * t / df) + b * math.log(y) - log_beta)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, y) / b


def _p_values(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([two_sided_p(a, b) for a, b in zip(t.astype(float), df.astype(float))])


def t_pvalue(t: Column, df: Column) -> Column:
    ship(SparkSession.active())
    return F.pandas_udf(_p_values, "double")(t, df)
