"""Cohort retention (Q11-Q15).

Input: one row per member ``(signup_month 'YYYY-MM', churned_month_offset)``,
offset NULL when the member never churned. A member is active at tenure t
unless ``offset IS NOT NULL AND offset <= t``.

One ``groupBy(cohort)`` with a conditional churn count per tenure produces
every number the operators need; the per-tenure grid is then an ``inline``
of that small per-cohort row, so no pivot job and no cross product of the
raw rows is needed. Cohorts whose tenure is beyond ``as_of`` are NULL
(unobservable), never zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.common import attach_scalars, ratio_pct_half_up


def _month_date(c: Column) -> Column:
    return F.to_date(F.concat(c, F.lit("-01")))


def _months_between(later: str, earlier: Column) -> Column:
    return F.months_between(_month_date(F.lit(later)), _month_date(earlier)).cast("int")


def cohort_counts(df: DataFrame, max_tenure: int, first_cohort: str | None = None,
                  last_cohort: str | None = None, cohort: str = "signup_month",
                  offset: str = "churned_month_offset") -> DataFrame:
    """Per cohort: ``n`` and ``churned_t`` = members churned by tenure t."""
    d = df.select(F.col(cohort).alias("cohort"), F.col(offset).cast("double").alias("_off"))
    if first_cohort:
        d = d.where(F.col("cohort") >= first_cohort)
    if last_cohort:
        d = d.where(F.col("cohort") <= last_cohort)
    # one count per cohort and whole month of churn, then sums over these few rows
    last = max_tenure + 1
    month = F.when(F.col("_off").isNull(), last).otherwise(F.least(F.greatest(F.ceil("_off"), F.lit(0)), F.lit(last)))
    seen = d.groupBy("cohort", month.cast("int").alias("_m")).agg(F.count(F.lit(1)).alias("_k"))
    churned = lambda t: F.coalesce(F.sum(F.when(F.col("_m") <= t, F.col("_k"))), F.lit(0))
    return seen.groupBy("cohort").agg(F.sum("_k").alias("n"),
                                      *[churned(t).alias(f"churned_{t}") for t in range(max_tenure + 1)])


def retention_long(df: DataFrame, as_of: str, max_tenure: int, **kw) -> DataFrame:
    """``(cohort, tenure, n, active, pct)`` for every observable cell."""
    cc = cohort_counts(df, max_tenure, **kw)
    cells = F.array(*[F.struct(F.lit(t).alias("tenure"), F.col(f"churned_{t}").alias("churned"))
                      for t in range(max_tenure + 1)])
    long = cc.select("cohort", "n", F.inline(cells))
    long = long.where(F.col("tenure") <= _months_between(as_of, F.col("cohort")))
    active = F.col("n") - F.col("churned")
    return long.select("cohort", "tenure", "n", active.alias("active"),
                       ratio_pct_half_up(active, F.col("n"), 1).alias("pct"))


def retention_matrix(df: DataFrame, as_of: str, max_tenure: int = 6, **kw) -> DataFrame:
    """Q11: ``(cohort, m0 .. mK)``; NULL where the cohort is too young."""
    cc = cohort_counts(df, max_tenure, **kw)
    max_obs = _months_between(as_of, F.col("cohort"))
    cols = [F.when(F.lit(t) <= max_obs,
                   ratio_pct_half_up(F.col("n") - F.col(f"churned_{t}"), F.col("n"), 1)).alias(f"m{t}")
            for t in range(max_tenure + 1)]
    return cc.select("cohort", *cols)


def retention_at_tenure(df: DataFrame, as_of: str, tenure: int = 1, **kw) -> DataFrame:
    """Q12: ``(cohort, pct, decline_first_to_last)`` for cohorts old enough."""
    r = retention_long(df, as_of, tenure, **kw).where(F.col("tenure") == tenure).select("cohort", "pct")
    ends = r.agg((F.min_by("pct", "cohort") - F.max_by("pct", "cohort")).alias("_d"))
    return attach_scalars(r, ends.select(F.round("_d", 1).alias("decline_first_to_last")))


def calendar_months(first: str, as_of: str) -> list[str]:
    y, m = map(int, first.split("-"))
    ye, me = map(int, as_of.split("-"))
    out = []
    while (y, m) <= (ye, me):
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def blended_active_rate(df: DataFrame, first_cohort: str, as_of: str, last_cohort: str | None = None,
                        **kw) -> DataFrame:
    """Q13: ``(calendar_month, active, total, pct)``: all cohorts that exist
    at each calendar month, weighted by their size."""
    horizon = len(calendar_months(first_cohort, as_of)) - 1
    r = retention_long(df, as_of, horizon, first_cohort=first_cohort, last_cohort=last_cohort, **kw)
    cal = F.date_format(F.add_months(_month_date(F.col("cohort")), F.col("tenure")), "yyyy-MM")
    g = r.groupBy(cal.alias("calendar_month")).agg(F.sum("active").alias("active"),
                                                    F.sum("n").alias("total"))
    return g.select("calendar_month", "active", "total",
                    ratio_pct_half_up(F.col("active"), F.col("total"), 1).alias("pct"))


def vintage_decline(df: DataFrame, as_of: str, tenure: int = 1, min_consecutive: int = 3,
                    drop_threshold: float = 1.0, **kw) -> DataFrame:
    """Q14: one row ``(confirmed, started_at, streak)``.

    A drop is ``pct < previous pct - drop_threshold``. A streak counts
    cohorts (it starts at 1 and grows by one per consecutive drop); the first
    cohort whose streak reaches ``max(min_consecutive, 2)`` confirms, and
    ``started_at`` is the cohort just before that run of drops. The windows
    below run on the aggregated cohort table (one row per cohort).
    """
    r = retention_at_tenure(df, as_of, tenure, **kw).select("cohort", "pct")
    w = Window.orderBy("cohort")
    is_drop = F.coalesce(F.col("pct") < F.lag("pct").over(w) - F.lit(drop_threshold), F.lit(False))
    r = r.withColumn("_drop", is_drop)
    r = r.withColumn("_island", F.sum(F.when(F.col("_drop"), 0).otherwise(1)).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    wi = Window.partitionBy("_island").orderBy("cohort")
    r = r.select("cohort", F.row_number().over(wi).alias("streak"),
                 F.first("cohort").over(wi).alias("run_start"))
    need = max(min_consecutive, 2)
    hit = r.where(F.col("streak") >= need)
    res = hit.agg(F.min_by("run_start", "cohort").alias("started_at"),
                  F.min_by("streak", "cohort").alias("streak"))
    return res.select((F.col("started_at").isNotNull()).alias("confirmed"), "started_at",
                      F.col("streak").cast("int").alias("streak"))


def mix_shift_projection(df: DataFrame, as_of: str, recovered_rate: float = 96,
                         new_cohort_size: int = 800, tenure: int = 1, **kw) -> DataFrame:
    """Q15: ``(before, after, movement)``: ``before`` is the unweighted mean of
    the cohorts' tenure-t retention; ``after`` weights it by the member count
    against one added cohort of ``new_cohort_size`` at ``recovered_rate``."""
    r = retention_at_tenure(df, as_of, tenure, **kw)
    before = r.agg(F.avg("pct").alias("before"))
    cc = cohort_counts(df, 0, **kw).agg(F.sum("n").alias("_total"))
    t = attach_scalars(before, cc)
    after = ((F.col("before") * F.col("_total") + F.lit(float(recovered_rate * new_cohort_size)))
             / (F.col("_total") + F.lit(new_cohort_size)))
    return t.select("before", after.alias("after"), (after - F.col("before")).alias("movement"))
