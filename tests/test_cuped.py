import math

import pytest
from pyspark.sql import functions as F

from helpers import one
from meridian.functions.stats import t_two_sided_p
from meridian.operators import cuped


def test_theta(fx):
    r = one(cuped.cuped_theta(fx("cuped")))
    assert (r.x_mean, r.y_mean) == (6.0, 7.8)
    assert abs(r.cov_xy - 6.1) < 1e-12 and abs(r.var_x - 6.0) < 1e-12 and abs(r.var_y - 7.36) < 1e-12
    assert abs(r.theta - 1.016667) < 1e-6 and abs(r.slope - r.theta) < 1e-12
    assert abs(r.intercept - 1.70) < 1e-9
    assert abs(r.variance_reduction - r.r ** 2) < 1e-12


def test_ttest_raw_and_adjusted(fx):
    out = {r.variant: r for r in cuped.cuped_ttest(fx("cuped")).collect()}
    raw, adj = out["raw"], out["adjusted"]
    assert abs(raw.t_stat - 1.68232) < 1e-5 and abs(raw.p_value - 0.109773) < 1e-6
    assert abs(adj.t_stat - 10.66228) < 1e-5 and abs(adj.p_value - 3.2996e-09) < 1e-12
    assert abs(raw.effect - adj.effect) < 1e-9 or abs(adj.effect - 2.0) < 0.2


def test_ttest_matches_two_pass(fx):
    """The one-scan adjusted moments equal the explicit two-pass computation."""
    df = fx("cuped")
    one_scan = {r.variant: r for r in cuped.cuped_ttest(df).collect()}["adjusted"]
    two_pass = one(cuped.arm_ttest(cuped.cuped_adjusted(df), "y_adjusted"))
    for f in ("control_mean", "treatment_mean", "control_var", "treatment_var", "t_stat", "p_value"):
        assert getattr(one_scan, f) == pytest.approx(getattr(two_pass, f), rel=1e-9)


def test_adjusted_properties(fx):
    df = cuped.cuped_adjusted(fx("cuped"))
    th = one(cuped.cuped_theta(fx("cuped")))
    r = one(df.agg(F.avg("y_adjusted").alias("m"), F.var_pop("y_adjusted").alias("v")))
    assert r.m == pytest.approx(th.y_mean)
    assert r.v == pytest.approx((1 - th.r ** 2) * th.var_y)


def test_missing_x(spark, fx):
    extra = spark.createDataFrame([("U98", "Control", None, 7), ("U99", "Treatment", None, 9)],
                                  fx("cuped").schema)
    df = fx("cuped").unionByName(extra)
    dropped = one(cuped.cuped_theta(df, missing_x="drop"))
    assert dropped.x_mean == 6.0
    adj = cuped.cuped_adjusted(df, missing_x="no_adjust").where(F.col("x_pre_sessions").isNull())
    assert [r.adjustment for r in adj.collect()] == [0.0, 0.0]
    assert cuped.cuped_adjusted(df).count() == 20


def test_pvalue_function():
    assert t_two_sided_p(0.0, 10) == pytest.approx(1.0)
    assert t_two_sided_p(2.228138851986, 10) == pytest.approx(0.05, rel=1e-8)
    assert math.isnan(t_two_sided_p(1.0, 0))


def test_pvalue_small_tails_and_few_degrees():
    # closed forms: one degree (Cauchy) and two degrees
    assert t_two_sided_p(3.0, 1) == pytest.approx(1 - 2 / math.pi * math.atan(3.0), rel=1e-12)
    assert t_two_sided_p(5.0, 2) == pytest.approx(1 - 5 / math.sqrt(27), rel=1e-11)
    assert t_two_sided_p(40.0, 2) == pytest.approx(1 - 40 / math.sqrt(1602), rel=1e-9)
    assert t_two_sided_p(1.959963984540054, 1e9) == pytest.approx(0.05, rel=1e-6)


def test_ttest_without_adjustment_of_missing_x(spark):
    rows = [("Treatment" if i % 2 else "Control", None if i % 5 == 0 else float(i % 7), float(i % 7) + i % 2 + i % 3) for i in range(40)]
    df = spark.createDataFrame(rows, "arm string, x_pre_sessions double, y_post_sessions double")
    got = {r.variant: r for r in cuped.cuped_ttest(df, missing_x="no_adjust").collect()}
    known = [(x, y) for _, x, y in rows if x is not None]
    xm, ym = (sum(v) / len(known) for v in zip(*known))
    theta = sum((x - xm) * (y - ym) for x, y in known) / sum((x - xm) ** 2 for x, _ in known)
    adj = {a: [y - (theta * (x - xm) if x is not None else 0) for b, x, y in rows if b == a] for a in ("Control", "Treatment")}
    mean = {a: sum(v) / len(v) for a, v in adj.items()}
    assert got["adjusted"].control_mean == pytest.approx(mean["Control"])
    assert got["adjusted"].effect == pytest.approx(mean["Treatment"] - mean["Control"])
    assert got["raw"].control_mean == pytest.approx(sum(y for a, _, y in rows if a == "Control") / 20)
    assert set(got["raw"].asDict()) == set(cuped.cuped_ttest(df).columns)
