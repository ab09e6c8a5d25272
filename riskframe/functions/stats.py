"""Student-t tail applied to already-aggregated rows (one row per test).

SciPy is not available; the regularised incomplete beta function is evaluated
by the continued fraction of DLMF 8.17.22, from its far end backwards. It runs
in a vectorised pandas UDF over the (tiny) result of a Spark aggregate.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


TERMS = 2000


def _beta_fraction(a: float, b: float, x: float) -> float:
    """1 / (1 + d1 / (1 + d2 / (1 + ...))), DLMF 8.17.22 and 8.17.23."""
    value = 1.0
    for n in range(TERMS, 0, -1):
        m = n // 2
        if n % 2:
            d = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            d = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        value = 1.0 + d / value
    return 1.0 / value


def betainc_reg(a: float, b: float, x: float) -> float:
    """I_x(a, b); by 8.17.4 the side where the fraction converges fast."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - betainc_reg(b, a, 1.0 - x)
    log_front = a * math.log(x) + b * math.log1p(-x) - math.log(a) - math.lgamma(a) - math.lgamma(b) + math.lgamma(a + b)
    return math.exp(log_front) * _beta_fraction(a, b, x)


def t_two_sided_p(t: float, dof: float) -> float:
    """Two-sided p-value of Student's t with ``dof`` degrees of freedom."""
    if t is None or dof is None or not math.isfinite(t) or dof <= 0:
        return float("nan")
    return betainc_reg(dof / 2.0, 0.5, dof / (dof + t * t))


def _t_p_batch(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_p(a, b) if pd.notna(a) and pd.notna(b) else float("nan") for a, b in zip(t, dof)])


def t_p_value(t: Column, dof: Column) -> Column:
    # UDFs are wrapped at call time: a module-level pandas_udf would need a session when workers import this module
    return F.pandas_udf(_t_p_batch, "double")(t.cast("double"), dof.cast("double"))


def stars(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")
