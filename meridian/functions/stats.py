"""Two-sample statistics as Spark column expressions.

Moments come from Spark's mergeable aggregates (``avg``, ``var_samp``,
``covar_pop``...), so they are computed with partial aggregation in one scan.
The t statistics are closed-form expressions on the aggregated row. The only
Python is the Student-t tail probability, an Arrow-batched pandas UDF that
runs on aggregated rows (one per test), never on the raw data.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.functions.common import safe_div

# The p-value UDF below is the only Python that runs inside executors. Ship
# this module's functions with the task (pickled by value) so workers need
# no installed copy of the package.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover - older cloudpickle
    pass


def pooled_t(n1: Column, m1: Column, v1: Column, n2: Column, m2: Column, v2: Column) -> Column:
    """Equal-variance two-sample t of (m2 - m1) with sample variances v1, v2."""
    dof = n1 + n2 - F.lit(2)
    sp2 = safe_div((n1 - 1) * v1 + (n2 - 1) * v2, dof)
    se = F.sqrt(sp2 * (safe_div(F.lit(1.0), n1) + safe_div(F.lit(1.0), n2)))
    return safe_div(m2 - m1, se)


def unpooled_t(n1: Column, m1: Column, v1: Column, n2: Column, m2: Column, v2: Column) -> Column:
    """(m2 - m1) / sqrt(v1/n1 + v2/n2) (unpooled standard error, no p-value)."""
    se = F.sqrt(safe_div(v1, n1) + safe_div(v2, n2))
    return safe_div(m2 - m1, se)


def relative_lift(control_mean: Column, treatment_mean: Column) -> Column:
    return safe_div(treatment_mean - control_mean, control_mean)


# --------------------------------------------------------------------------- Student t tail
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(40)
_PANELS = 16


def t_two_sided_p(t: float, dof: float) -> float:
    """Two-sided p-value of Student's t with ``dof`` degrees of freedom.

    With ``s = sqrt(dof) tan(u)`` the density of ``s`` becomes a constant times
    ``cos(u) ** (dof - 1)`` on ``(-pi/2, pi/2)``, so the tail beyond ``|t|`` is a
    proper integral of a smooth function. It is taken by Gauss-Legendre panels
    from ``atan(|t| / sqrt(dof))`` to where the integrand has fallen by 1e-20,
    relative to its value at the start, which keeps small tails accurate."""
    if t is None or dof is None or math.isnan(t) or not dof > 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    start = math.atan2(abs(t), math.sqrt(dof))
    end = math.pi / 2
    if dof > 1:
        end = math.acos(math.cos(start) * 10 ** (-20 / (dof - 1)))
    edges = np.linspace(start, end, _PANELS + 1)
    half = np.diff(edges) / 2
    u = (edges[:-1] + half)[:, None] + half[:, None] * _NODES
    drop = (dof - 1) * (np.log(np.cos(u)) - math.log(math.cos(start))) if dof != 1 else np.zeros_like(u)
    area = float((np.exp(drop) * _WEIGHTS * half[:, None]).sum())
    scale = math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2) - math.log(math.pi) / 2
    return min(1.0, 2 * area * math.exp(scale + (dof - 1) * math.log(math.cos(start))))


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, dof: pd.Series) -> pd.Series:
    """Arrow-batched two-sided Student-t p-value (runs on aggregated rows)."""
    out = [None if (pd.isna(a) or pd.isna(b)) else t_two_sided_p(float(a), float(b))
           for a, b in zip(t, dof)]
    return pd.Series(out, dtype="float64")
