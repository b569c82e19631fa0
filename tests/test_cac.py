from helpers import one
from meridian.operators import cac


def test_nominal(fx):
    out = {r.side: r for r in cac.nominal_cac(fx("cac_spend")).collect()}
    assert out["guest"].nominal_cac == 30.11 and out["host"].nominal_cac == 148.88
    assert (out["guest"].acquisitions, out["host"].acquisitions) == (608, 97)


def test_ramp_curve(fx):
    rows = cac.ramp_curve(fx("host_ramp")).orderBy("month").collect()
    assert [r.pct_of_steady_state for r in rows] == [10.4, 37.5, 66.6, 97.2, 98.8, 104.0]
    assert abs(rows[0].steady_state - 204.711867) < 1e-6


def test_shortfall_and_effective(fx):
    assert abs(one(cac.ramp_shortfall(fx("host_ramp"))).shortfall - 385.504067) < 1e-6
    out = {r.side: r for r in cac.effective_cac(fx("cac_spend"), fx("host_ramp")).collect()}
    assert out["host"].effective_cac == 534.38 and out["guest"].effective_cac == 30.11
    assert round(out["host"].nominal_ratio, 2) == 4.94 and round(out["host"].effective_ratio, 2) == 17.75
    assert one(cac.churn_replacement_cost(fx("cac_spend"), fx("host_ramp"))).replacement_cost == 534.38


def test_compression(fx):
    r = one(cac.ramp_compression(fx("host_ramp"), compression=0.5))
    assert abs(r.original_shortfall - 385.504067) < 1e-6
    assert round(r.compressed_shortfall, 3) == 133.714 and round(r.value_unlocked, 3) == 251.790


def test_missing_steady_month_is_null(fx):
    from pyspark.sql import functions as F
    df = fx("host_ramp").where(F.col("month_since_signup") != 5)
    assert one(cac.ramp_shortfall(df)).shortfall is None


def test_two_table_load(spark):
    import os
    from helpers import FIX
    from meridian.sources.io import read_cac_inputs
    spend, ramp = read_cac_inputs(spark, os.path.join(FIX, "marketing_spend_acquisitions.csv"),
                                  os.path.join(FIX, "host_ramp_productivity.csv"))
    assert (spend.count(), ramp.count()) == (12, 300)
