from pyspark.sql import functions as F

from helpers import one
from meridian.operators import rdd


def test_estimate_bandwidth_1000(fx):
    r = one(rdd.discontinuity_estimate(fx("rdd"), bandwidth=1000, cutoff=10000))
    assert (r.n_below, r.n_above) == (161, 131)
    assert abs(r.estimate - 478.940378) < 1e-6


def test_bandwidth_sensitivity(fx):
    out = {r.bandwidth: r.estimate for r in rdd.bandwidth_sensitivity(fx("rdd")).collect()}
    got = [round(out[b], 2) for b in (250, 500, 1000, 1500, 2000)]
    assert got == [459.27, 462.06, 478.94, 516.93, 547.44]


def test_placebo_cutoffs(fx):
    out = {r.cutoff: round(r.estimate, 2) for r in rdd.placebo_cutoffs(fx("rdd")).collect()}
    assert out == {8000.0: 101.29, 9000.0: 42.36, 11500.0: 66.33, 12000.0: 209.14}


def test_band_summary(fx):
    rows = rdd.band_summary(fx("rdd")).orderBy("band_order").collect()
    assert [(r.n, r.avg_spend) for r in rows] == [
        (95, 1821.93), (104, 1924.48), (99, 1953.68), (62, 1954.39),
        (64, 2416.44), (67, 2448.60), (74, 2590.62), (103, 2805.41)]
    assert rows[-1].band == "12000+"


def test_density_not_suspicious(fx):
    rows = rdd.density_check(fx("rdd")).orderBy("bin_index").collect()
    assert [r["count"] for r in rows] == [40, 26, 26, 29, 24, 29, 19, 32]
    assert rows[0].bin_label == "9200-9399"
    assert abs(rows[0].ratio - 29 / 26) < 1e-12 and rows[0].suspicious is False


def test_density_bunched_fixture_flags(fx):
    # every row in [10000, 10150) moved deterministically into [9900, 10000)
    x = F.col("points_score")
    moved = fx("rdd").withColumn(
        "points_score",
        F.when((x >= 10000) & (x < 10150), F.lit(9900) + ((x - 10000) * 99 / 150).cast("long")).otherwise(x))
    r = rdd.density_check(moved).collect()[0]
    assert abs(r.ratio - 49 / 26) < 1e-12 and r.suspicious is True


def test_density_last_bin_closed_and_empty_bins(spark):
    df = spark.createDataFrame([(10800,), (10800,), (9200,)], "points_score long")
    rows = rdd.density_check(df).orderBy("bin_index").collect()
    assert [r["count"] for r in rows] == [1, 0, 0, 0, 0, 0, 0, 2]
    assert rows[0].ratio is None and rows[0].suspicious is False


def test_estimate_empty_window(spark):
    df = spark.createDataFrame([(1, 5.0)], "points_score long, annual_spend double")
    r = one(rdd.discontinuity_estimate(df, bandwidth=10, cutoff=10000))
    assert (r.n_below, r.n_above, r.estimate) == (0, 0, None)


def test_missing_outcome_counts_as_row(spark):
    df = spark.createDataFrame([(9990, None), (9995, 10.0), (10005, 20.0)], "points_score long, annual_spend double")
    r = one(rdd.discontinuity_estimate(df, bandwidth=100, cutoff=10000))
    assert (r.n_below, r.n_above, r.below_mean, r.estimate) == (2, 1, 10.0, 10.0)


def test_sweep_equals_the_conditional_aggregates(spark, fx):
    df = fx("rdd")
    pairs = [(c, 500.0) for c in (8000, 9000, 11500, 12000)] + [(10000, b) for b in (250, 500, 1000, 1500, 2000)]
    want = {(r.cutoff, r.bandwidth): r for r in rdd.placebo_cutoffs(df).unionByName(rdd.bandwidth_sensitivity(df)).collect()}
    got = rdd.sweep(df, spark.createDataFrame([(float(c), float(b)) for c, b in pairs], "cutoff double, bandwidth double"),
                    num_partitions=5)
    rows = got.collect()
    assert len(rows) == 9
    for r in rows:
        w = want[(r.cutoff, r.bandwidth)]
        assert (r.n_below, r.n_above) == (w.n_below, w.n_above)
        assert abs(r.estimate - w.estimate) < 1e-9 and abs(r.below_mean - w.below_mean) < 1e-9


def test_sweep_of_ten_thousand_windows_and_missing_values(spark):
    import random
    rnd = random.Random(8)
    data = [(float(rnd.randrange(0, 60)) if rnd.random() > .05 else None, round(rnd.gauss(0, 9), 3) if rnd.random() > .1 else None)
            for _ in range(400)]
    grid = [(float(c), b / 4) for c in range(-20, 80) for b in range(1, 101)]
    got = {(r.cutoff, r.bandwidth): r for r in rdd.sweep(
        spark.createDataFrame(data, "points_score double, annual_spend double"),
        spark.createDataFrame(grid, "cutoff double, bandwidth double"), num_partitions=7).collect()}
    assert len(got) == len(grid)
    for c, b in grid[::37]:
        below = [y for x, y in data if x is not None and c - b <= x < c]
        above = [y for x, y in data if x is not None and c <= x < c + b]
        r = got[(c, b)]
        assert (r.n_below, r.n_above) == (len(below), len(above))
        for side, mean in ((below, r.below_mean), (above, r.above_mean)):
            ys = [y for y in side if y is not None]
            assert mean is None if not ys else abs(mean - sum(ys) / len(ys)) < 1e-9


def test_sweep_of_no_rows(spark):
    none = spark.createDataFrame([], "points_score double, annual_spend double")
    pairs = spark.createDataFrame([(1.0, 2.0)], "cutoff double, bandwidth double")
    r = rdd.sweep(none, pairs).collect()
    assert [(x.n_below, x.n_above, x.estimate) for x in r] == [(0, 0, None)]
    assert rdd.sweep(none, pairs.limit(0)).count() == 0
