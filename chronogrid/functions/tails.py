"""Two-sided tail probability of Student's t, for rows that are already aggregated."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def regularised_beta(a: float, b: float, x: float) -> float:
    """I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_tail(t: float | None, freedom: float | None) -> float | None:
    """P(|T| >= |t|) with the given degrees of freedom."""
    if t is None or freedom is None or math.isnan(t) or math.isnan(freedom) or freedom <= 0:
        return None
    if math.isinf(t):
        return 0.0
    return regularised_beta(freedom / 2.0, 0.5, freedom / (freedom + t * t))


@F.pandas_udf(DoubleType())
def _t_tails(t: pd.Series, freedom: pd.Series) -> pd.Series:
    return pd.Series([t_tail(a, b) for a, b in zip(t, freedom)], dtype="float64")


def two_sided_p(t: Column, freedom: Column) -> Column:
    """p-value of a t statistic; use on aggregated rows only."""
    return _t_tails(t.cast("double"), freedom.cast("double"))


def pearson_p(r: Column, n: Column) -> Column:
    """Two-sided p-value of a Pearson correlation over n pairs; 0 for |r| = 1."""
    t = F.when(F.abs(r) >= 1.0, F.lit(float("inf"))).otherwise(
        r * F.sqrt(F.try_divide(n - 2, 1 - r * r))
    )
    return F.when(n > 2, two_sided_p(t, n - 2))
