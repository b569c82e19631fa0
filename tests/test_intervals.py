"""Values joined with tables of bands, against a plain nested loop."""
import math
import random

import pytest
from pyspark.sql import functions as F

from meridian.functions.intervals import match_bands
from meridian.operators import rdd

BANDS = "lo double, hi double, name string"


def _frames(spark, values, bands):
    return (spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, x double"),
            spark.createDataFrame(bands, BANDS))


def _brute(values, bands):
    return sorted((i, b[2]) for i, v in enumerate(values) if v is not None and not math.isnan(v)
                  for b in bands if b[0] is not None and b[1] is not None and b[0] <= v < b[1])


@pytest.mark.parametrize("seed", range(3))
def test_random_overlapping_bands(spark, seed):
    r = random.Random(seed)
    values = [r.choice([r.randint(-20, 120), r.random() * 100, None, float("nan"), 7]) for _ in range(300)]
    values = [None if v is None else float(v) for v in values]
    bands = []
    for i in range(60):
        lo = float(r.randint(-10, 100))
        bands.append((r.choice([lo, lo, lo, None]), lo + r.choice([-3, 0, 1, 2, 5, 40, 0.25]), f"b{i}"))
    bands.append((-math.inf, math.inf, "all"))
    df, table = _frames(spark, values, bands)
    got = match_bands(df, table, "x", hot_rows=20, salt_rows=7, num_partitions=5)
    assert got.columns == ["id", "x", "lo", "hi", "name"]
    assert sorted((g.id, g.name) for g in got.collect()) == _brute(values, bands)


def test_repeated_rows_bands_and_negative_zero(spark):
    df = spark.createDataFrame([(1, -0.0), (1, -0.0), (2, 0.0)], "id int, x double")
    table = spark.createDataFrame([(0.0, 1.0, "a"), (0.0, 1.0, "a"), (-1.0, -0.0, "below")], BANDS)
    assert sorted((g.id, g.name) for g in match_bands(df, table, "x").collect()) == [(1, "a")] * 4 + [(2, "a")] * 2


def test_empty_sides_and_clashing_names(spark):
    df, table = _frames(spark, [1.0, 2.0], [(0.0, 5.0, "a")])
    assert match_bands(df.limit(0), table, "x").count() == 0
    assert match_bands(df, table.limit(0), "x").count() == 0
    with pytest.raises(ValueError, match="lo"):
        match_bands(df.withColumn("lo", F.lit(1)), table, "x")


def test_many_bands_and_a_hot_value(spark):
    """100,000 bands, a third of the rows at one value: every row finds its band,
    and the plan has no nested loop, even where sides may be broadcast."""
    df = spark.range(300_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(500.5)).otherwise(F.col("id") / 3.0).alias("x"))
    table = spark.range(100_000).select(F.col("id").cast("double").alias("lo"), (F.col("id") + 1).cast("double").alias("hi"),
                                        F.col("id").alias("band"))
    got = match_bands(df, table, "x", hot_rows=50_000, salt_rows=10_000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    r = got.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("band") != F.floor("x")).alias("bad"),
                F.countDistinct("id").alias("ids")).first()
    assert (r.n, r.bad, r.ids) == (300_000, 0, 300_000)


def test_band_table_summary_equals_the_fixed_bands(spark, fx):
    edges, labels = rdd.DEFAULT_BAND_EDGES, rdd.DEFAULT_BAND_LABELS
    table = spark.createDataFrame([(float(a), float(b), n) for a, b, n in zip(edges, edges[1:], labels)], "lo double, hi double, band string")
    got = {r.band: (r.n, round(r.avg, 6)) for r in rdd.band_table_summary(fx("rdd"), table).collect() if r.n}
    want = {r.band: (r.n, round(r.avg_spend, 6)) for r in rdd.band_summary(fx("rdd"), digits=None).collect()}
    assert got == want


def test_band_table_summary_of_odd_bands(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None), (3.0, 4.0), (None, 9.0), (float("nan"), 9.0)], "points_score double, annual_spend double")
    table = spark.createDataFrame([(1.0, 3.0, "a"), (3.0, 3.0, "empty"), (0.0, 9.0, "b"), (None, 2.0, "null"), (50.0, 60.0, "none")], BANDS)
    got = {r.name: (r.n, r.total, r.avg) for r in rdd.band_table_summary(df, table).collect()}
    assert got == {"a": (1, 2.0, 2.0), "b": (2, 6.0, 3.0), "none": (0, 0.0, None)}
