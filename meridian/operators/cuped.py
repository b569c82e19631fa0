"""CUPED variance reduction (Q16-Q18).

theta is fitted on both arms pooled (population moments). The t-test uses
sample variances and the pooled (equal-variance) form.

``cuped_ttest`` needs one scan: the adjusted outcome is linear in (x, y), so
the per-arm mean and sample variance of ``y - theta * (x - mean_x)`` follow
from per-arm ``avg``/``var_samp``/``covar_samp`` of x and y plus the pooled
theta, all computed in the same aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.common import attach_scalars, safe_div
from meridian.functions.stats import pooled_t, t_pvalue

MISSING_X_MODES = ("drop", "no_adjust")


def _complete(df: DataFrame, x: str, y: str, missing_x: str) -> DataFrame:
    if missing_x not in MISSING_X_MODES:
        raise ValueError(f"missing_x must be one of {MISSING_X_MODES}")
    base = df.where(F.col(y).isNotNull())
    return base.where(F.col(x).isNotNull()) if missing_x == "drop" else base


def theta_aggs(x: Column, y: Column) -> list[Column]:
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    return [
        F.avg(xx).alias("x_mean"), F.avg(yy).alias("y_mean"),
        F.covar_pop(xx, yy).alias("cov_xy"), F.var_pop(xx).alias("var_x"),
        F.var_pop(yy).alias("var_y"),
        safe_div(F.covar_pop(xx, yy), F.var_pop(xx)).alias("theta"),
        F.corr(xx, yy).alias("r"), F.pow(F.corr(xx, yy), 2).alias("variance_reduction"),
        F.regr_slope(yy, xx).alias("slope"), F.regr_intercept(yy, xx).alias("intercept"),
    ]


def cuped_theta(df: DataFrame, x: str = "x_pre_sessions", y: str = "y_post_sessions",
                missing_x: str = "drop") -> DataFrame:
    """Q16: one row of pooled moments, theta, r, r^2 and the fitted line."""
    base = _complete(df, x, y, missing_x)
    return base.agg(*theta_aggs(F.col(x).cast("double"), F.col(y).cast("double")))


def cuped_adjusted(df: DataFrame, x: str = "x_pre_sessions", y: str = "y_post_sessions",
                   missing_x: str = "drop") -> DataFrame:
    """Q17: per-row ``adjustment = theta * (x - mean_x)`` and
    ``y_adjusted = y - adjustment`` (rows with no x are left unadjusted
    under ``missing_x='no_adjust'``)."""
    base = _complete(df, x, y, missing_x)
    fit = cuped_theta(df, x, y, missing_x).select(F.col("theta").alias("_theta"),
                                                   F.col("x_mean").alias("_xm"))
    adj = F.coalesce(F.col("_theta") * (F.col(x) - F.col("_xm")), F.lit(0.0))
    return (attach_scalars(base, fit)
            .withColumn("adjustment", adj)
            .withColumn("y_adjusted", F.col(y) - F.col("adjustment"))
            .drop("_theta", "_xm"))


def cuped_ttest(df: DataFrame, x: str = "x_pre_sessions", y: str = "y_post_sessions",
                arm: str = "arm", control: str = "Control", treatment: str = "Treatment",
                missing_x: str = "drop", with_p: bool = True) -> DataFrame:
    """Q18: rows ``variant in (raw, adjusted)`` with control/treatment mean,
    effect, sample variances, pooled t and (optionally) the two-sided p."""
    if missing_x == "no_adjust":
        # the one-scan shortcut needs complete rows; rows without x keep their y
        adjusted = cuped_adjusted(df, x, y, missing_x)
        return (arm_ttest(adjusted, y, arm, control, treatment, with_p).withColumn("variant", F.lit("raw"))
                .unionByName(arm_ttest(adjusted, "y_adjusted", arm, control, treatment, with_p)
                             .withColumn("variant", F.lit("adjusted"))))
    base = _complete(df, x, y, missing_x)
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    aggs = [F.avg(xc).alias("xbar"), safe_div(F.covar_pop(xc, yc), F.var_pop(xc)).alias("theta")]
    for tag, name in (("c", control), ("t", treatment)):
        on = F.col(arm) == name
        xa, ya = F.when(on, xc), F.when(on, yc)
        aggs += [F.count(ya).alias(f"n_{tag}"), F.avg(ya).alias(f"my_{tag}"),
                 F.var_samp(ya).alias(f"vy_{tag}"), F.avg(xa).alias(f"mx_{tag}"),
                 F.var_samp(xa).alias(f"vx_{tag}"), F.covar_samp(xa, ya).alias(f"cxy_{tag}")]
    m = base.agg(*aggs)
    th = F.coalesce(F.col("theta"), F.lit(0.0))

    def stats(variant: str, mean_c, mean_t, var_c, var_t) -> Column:
        t = pooled_t(F.col("n_c"), mean_c, var_c, F.col("n_t"), mean_t, var_t)
        return F.struct(F.lit(variant).alias("variant"), mean_c.alias("control_mean"),
                        mean_t.alias("treatment_mean"), (mean_t - mean_c).alias("effect"),
                        var_c.alias("control_var"), var_t.alias("treatment_var"), t.alias("t_stat"),
                        (F.col("n_c") + F.col("n_t") - 2).alias("dof"))

    adj_mean = lambda g: F.col(f"my_{g}") - th * (F.col(f"mx_{g}") - F.col("xbar"))
    adj_var = lambda g: (F.col(f"vy_{g}") - 2 * th * F.col(f"cxy_{g}")
                         + th * th * F.col(f"vx_{g}"))
    rows = F.array(
        stats("raw", F.col("my_c"), F.col("my_t"), F.col("vy_c"), F.col("vy_t")),
        stats("adjusted", adj_mean("c"), adj_mean("t"), adj_var("c"), adj_var("t")))
    out = m.select(F.inline(rows))
    if with_p:
        out = out.withColumn("p_value", t_pvalue(F.col("t_stat"), F.col("dof").cast("double")))
    return out.drop("dof")


def arm_ttest(df: DataFrame, value: str, arm: str = "arm", control: str = "Control",
              treatment: str = "Treatment", with_p: bool = True) -> DataFrame:
    """Pooled two-sample t-test of ``value`` between two arms (one scan)."""
    aggs = []
    for tag, name in (("c", control), ("t", treatment)):
        v = F.when(F.col(arm) == name, F.col(value).cast("double"))
        aggs += [F.count(v).alias(f"n_{tag}"), F.avg(v).alias(f"m_{tag}"), F.var_samp(v).alias(f"v_{tag}")]
    m = df.agg(*aggs)
    t = pooled_t(F.col("n_c"), F.col("m_c"), F.col("v_c"), F.col("n_t"), F.col("m_t"), F.col("v_t"))
    out = m.select(F.col("m_c").alias("control_mean"), F.col("m_t").alias("treatment_mean"),
                   (F.col("m_t") - F.col("m_c")).alias("effect"), F.col("v_c").alias("control_var"),
                   F.col("v_t").alias("treatment_var"), t.alias("t_stat"),
                   (F.col("n_c") + F.col("n_t") - 2).cast("double").alias("_dof"))
    if with_p:
        out = out.withColumn("p_value", t_pvalue(F.col("t_stat"), F.col("_dof")))
    return out.drop("_dof")
