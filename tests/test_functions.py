from pyspark.sql import functions as F

from meridian.functions.common import ratio_pct_half_up, round_doubles, top_rows
from meridian.functions.joins import hot_split_join
from meridian.functions.ranking import dense_rank_values


def test_hot_split_join_inner_and_left(spark):
    big = spark.createDataFrame([("h", i) for i in range(50)] + [("c", 1), ("x", 2)], "k string, v long")
    dim = spark.createDataFrame([("h", "H", 50), ("c", "C", 1)], "k string, name string, n long")
    for how in ("inner", "left"):
        plain = {tuple(r) for r in big.join(dim.drop("n"), "k", how).collect()}
        exact = {tuple(r) for r in hot_split_join(big, dim, ["k"], "n", hot_rows=10, how=how).collect()}
        sampled = {tuple(r) for r in hot_split_join(big, dim.drop("n"), ["k"], hot_rows=10, how=how,
                                                    big_rows=52).collect()}
        assert exact == plain and sampled == plain
    assert hot_split_join(big, dim, ["k"], "n", hot_rows=10).count() == 51


def test_sampled_hot_key_detection(spark):
    from meridian.functions.joins import _hot_keys
    big = spark.range(300_000).select((F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))).alias("k"))
    hot = [r.k for r in _hot_keys(big, None, ["k"], None, hot_rows=50_000, big_rows=300_000).collect()]
    assert hot == [-1]


def test_dense_rank_matches_window(spark):
    df = spark.createDataFrame([(f"r{i % 37:03d}",) for i in range(500)], "x string")
    rk = dense_rank_values(df, "x", num_partitions=5)
    ranked, n = rk.df, rk.n_values
    assert n == 37 and rk.n_rows == 500
    got = {r.x: r["rank"] for r in ranked.collect()}
    assert got == {f"r{i:03d}": i + 1 for i in range(37)}


def test_ratio_half_up_exact(spark):
    df = spark.createDataFrame([(3, 16), (1, 8), (2, 3), (0, 0)], "a long, t long")
    out = [r.p for r in df.select(ratio_pct_half_up(F.col("a"), F.col("t"), 1).alias("p")).collect()]
    assert out == [18.8, 12.5, 66.7, None]


def test_round_doubles_and_top_rows(spark):
    df = spark.createDataFrame([(1, 0.1234567891), (2, 2.5)], "k long, v double")
    assert [r.v for r in round_doubles(df, 3).orderBy("k").collect()] == [0.123, 2.5]
    assert [r.k for r in top_rows(df, 1, F.desc("v")).collect()] == [2]


def test_interval_preagg_by_time(spark):
    from meridian.operators.switchback import interval_preagg_by_time
    df = spark.createDataFrame(
        [("Z1", "Control", "2024-01-01 00:01:00", 1.0), ("Z1", "Control", "2024-01-01 00:04:59", 3.0),
         ("Z1", "Control", "2024-01-01 00:05:00", 5.0)],
        "zone string, assignment string, ts string, wait_time_min double").withColumn("ts", F.to_timestamp("ts"))
    rows = interval_preagg_by_time(df).orderBy("interval_start").collect()
    assert [(r.wait_time_min, r.n_events) for r in rows] == [(2.0, 2), (5.0, 1)]


def test_hottest_keys_are_split_above_the_limit(spark):
    from meridian.functions.joins import _hot_keys, hot_split_join
    big = spark.range(6_000).select(F.when(F.col("id") < 3_000, -1).when(F.col("id") < 5_000, -2).otherwise(-3).alias("k"), "id")
    dim = spark.createDataFrame([(-1, 3_000), (-2, 2_000), (-3, 1_000)], "k long, w long")
    assert [r.k for r in _hot_keys(big, dim, ["k"], "w", 500, None, 2).collect()] == [-1, -2]
    for how, n in (("inner", 6_000), ("left", 6_000), ("left_semi", 6_000), ("left_anti", 0)):
        out = hot_split_join(big, dim, ["k"], "w", hot_rows=500, max_broadcast_keys=2, how=how)
        assert out.count() == n, how
    gone = hot_split_join(big, dim.where("k = -1"), ["k"], hot_rows=500, big_rows=6_000, how="left_anti")
    assert gone.count() == 3_000
