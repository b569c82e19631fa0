"""Acquisition-cost operators: nominal CAC, host ramp curve, ramp shortfall,
effective CAC and the ramp-compression projection (Q31-Q36).

The raw inputs are aggregated first (one row per side, one row per month
since signup); every later step works on those few rows, attached to each
other through broadcast joins of one-row results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions.common import attach_scalars, safe_div

# Ramp period, steady-state months and the last observed month.
RAMP_MONTHS = 4
STEADY_STATE_MONTHS = (4, 5, 6)
MAX_MONTH = 6


def nominal_cac(spend_df: DataFrame, side: str = "side", spend: str = "spend",
                acquisitions: str = "acquisitions", digits: int = 2) -> DataFrame:
    """Q31: ``(side, spend, acquisitions, nominal_cac)`` = ratio of sums."""
    t = spend_df.groupBy(F.col(side).alias("side")).agg(
        F.sum(spend).alias("spend"), F.sum(acquisitions).alias("acquisitions"))
    return t.withColumn("nominal_cac", F.round(safe_div(F.col("spend"), F.col("acquisitions")), digits))


def by_month(ramp_df: DataFrame, month: str = "month_since_signup",
             revenue: str = "monthly_revenue") -> DataFrame:
    return ramp_df.groupBy(F.col(month).alias("month")).agg(F.avg(revenue).alias("avg_revenue"))


def steady_state(months_df: DataFrame, steady_months: Sequence[int] = STEADY_STATE_MONTHS) -> DataFrame:
    """Mean of the monthly means over the steady-state months (NULL when one
    of them is missing, instead of silently averaging fewer months)."""
    in_ss = F.col("month").isin(list(steady_months))
    return months_df.agg(
        F.when(F.count(F.when(in_ss, F.lit(1))) == len(set(steady_months)),
               F.avg(F.when(in_ss, F.col("avg_revenue")))).alias("steady_state"))


def ramp_curve(ramp_df: DataFrame, steady_months: Sequence[int] = STEADY_STATE_MONTHS,
               month: str = "month_since_signup", revenue: str = "monthly_revenue") -> DataFrame:
    """Q32: ``(month, avg_revenue, steady_state, pct_of_steady_state)``."""
    bm = by_month(ramp_df, month, revenue)
    out = attach_scalars(bm, steady_state(bm, steady_months))
    return out.withColumn("pct_of_steady_state",
                          F.round(safe_div(F.col("avg_revenue"), F.col("steady_state")) * 100, 1))


def _shortfall(bm: DataFrame, ss: DataFrame, ramp_months: int) -> DataFrame:
    in_ramp = F.col("month").between(1, ramp_months)
    # greatest() skips NULLs, so guard the missing-steady-state case explicitly
    gap = F.when(F.col("steady_state").isNotNull(),
                 F.greatest(F.col("steady_state") - F.col("avg_revenue"), F.lit(0.0)))
    return attach_scalars(bm, ss).agg(
        # every ramp month must be present, as in the month-indexed lookup it restates
        F.when(F.count(F.when(in_ramp, F.lit(1))) == ramp_months,
               F.sum(F.when(in_ramp, gap))).alias("shortfall"),
        F.first("steady_state").alias("steady_state"))


def ramp_shortfall(ramp_df: DataFrame, ramp_months: int = RAMP_MONTHS,
                   steady_months: Sequence[int] = STEADY_STATE_MONTHS,
                   month: str = "month_since_signup", revenue: str = "monthly_revenue") -> DataFrame:
    """Q33: one row ``(shortfall, steady_state)``: sum over the ramp months of
    ``max(steady_state - avg_revenue, 0)``."""
    bm = by_month(ramp_df, month, revenue)
    return _shortfall(bm, steady_state(bm, steady_months), ramp_months)


def effective_cac(spend_df: DataFrame, ramp_df: DataFrame, supply_side: str = "host",
                  demand_side: str = "guest", ramp_months: int = RAMP_MONTHS,
                  steady_months: Sequence[int] = STEADY_STATE_MONTHS) -> DataFrame:
    """Q34: ``(side, nominal_cac, effective_cac, shortfall, nominal_ratio,
    effective_ratio)``. Only the supply side carries the ramp shortfall;
    effective = round(rounded nominal + unrounded shortfall, 2)."""
    nom = nominal_cac(spend_df).select("side", "nominal_cac")
    sf = ramp_shortfall(ramp_df, ramp_months, steady_months).select("shortfall")
    eff = attach_scalars(nom, sf).select(
        "side", "nominal_cac",
        F.when(F.col("side") == supply_side,
               F.round(F.col("nominal_cac") + F.col("shortfall"), 2))
        .otherwise(F.col("nominal_cac")).alias("effective_cac"),
        F.when(F.col("side") == supply_side, F.col("shortfall")).otherwise(F.lit(0.0)).alias("shortfall"))
    pick = lambda c, s: F.max(F.when(F.col("side") == s, F.col(c)))
    ratios = eff.agg(
        safe_div(pick("nominal_cac", supply_side), pick("nominal_cac", demand_side)).alias("nominal_ratio"),
        safe_div(pick("effective_cac", supply_side), pick("effective_cac", demand_side)).alias("effective_ratio"))
    return attach_scalars(eff, ratios)


def churn_replacement_cost(spend_df: DataFrame, ramp_df: DataFrame, supply_side: str = "host",
                           **kw) -> DataFrame:
    """Q35: one row: the full effective supply-side CAC paid again on churn."""
    return (effective_cac(spend_df, ramp_df, supply_side=supply_side, **kw)
            .where(F.col("side") == supply_side)
            .select(F.col("effective_cac").alias("replacement_cost")))


def ramp_compression(ramp_df: DataFrame, compression: float = 0.5, ramp_months: int = RAMP_MONTHS,
                     steady_months: Sequence[int] = STEADY_STATE_MONTHS, max_month: int = MAX_MONTH,
                     month: str = "month_since_signup", revenue: str = "monthly_revenue") -> DataFrame:
    """Q36: shortfall if month m earned what month round_half_even(min(m/c,
    max_month)) earned (steady state when that month is absent); returns
    ``(original_shortfall, compressed_shortfall, value_unlocked)``."""
    bm = by_month(ramp_df, month, revenue)
    ss = steady_state(bm, steady_months)
    original = _shortfall(bm, ss, ramp_months).select(F.col("shortfall").alias("original_shortfall"))
    spark = ramp_df.sparkSession
    src = F.bround(F.least(F.col("m") / F.lit(compression), F.lit(float(max_month))), 0).cast("long")
    grid = spark.range(1, ramp_months + 1).select(F.col("id").alias("m")).select("m", src.alias("month"))
    looked = grid.join(bm, "month", "left")
    looked = attach_scalars(looked, ss)
    rev = F.coalesce(F.col("avg_revenue"), F.col("steady_state"))
    gap = F.when(F.col("steady_state").isNotNull(), F.greatest(F.col("steady_state") - rev, F.lit(0.0)))
    comp = looked.agg(F.sum(gap).alias("compressed_shortfall"))
    out = attach_scalars(original, comp)
    return out.withColumn("value_unlocked", F.col("original_shortfall") - F.col("compressed_shortfall"))
