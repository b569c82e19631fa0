import os

import pandas as pd

from helpers import FIX
from meridian.operators import segmentation as seg


def golden(name):
    return pd.read_csv(os.path.join(FIX, "golden", name))


def test_rule_segments_golden(fx):
    got = seg.rule_segments(fx("rule_customers")).toPandas().sort_values("customer_id").reset_index(drop=True)
    exp = golden("rule_based_segmented.csv").sort_values("customer_id").reset_index(drop=True)
    assert list(got.segment) == list(exp.segment)
    counts = {r.segment: r["count"] for r in seg.segment_counts(seg.rule_segments(fx("rule_customers"))).collect()}
    assert counts == {"Mature Low-Value": 20, "Mature High-Value": 13, "Young High-Value": 4, "Young Low-Value": 3}


def test_rule_missing_age_is_mature(spark):
    df = spark.createDataFrame([("a", None, 900.0), ("b", 20, None)], "customer_id string, age long, annual_spend double")
    out = {r.customer_id: r.segment for r in seg.rule_segments(df).collect()}
    assert out == {"a": "Mature High-Value", "b": "Young Low-Value"}


def test_rfm_golden(fx):
    got = seg.rfm_segments(fx("rfm_customers")).toPandas().sort_values("customer_id").reset_index(drop=True)
    exp = golden("rfm_segmented.csv").sort_values("customer_id").reset_index(drop=True)
    for c in ("r_score", "f_score", "m_score", "rfm_total", "segment"):
        assert list(got[c]) == list(exp[c]), c


def test_kmeans_segments_golden(fx):
    got = seg.kmeans_segments(fx("kmeans_customers")).toPandas().set_index("customer_id").segment
    exp = golden("kmeans_segmented.csv").set_index("customer_id").segment
    assert got.sort_index().to_dict() == exp.sort_index().to_dict()


def test_kmeans_label_count_must_match_k(fx):
    import pytest
    with pytest.raises(ValueError):
        seg.kmeans_segments(fx("kmeans_customers"), k=2)


def test_kmeans_keeps_rows_with_missing_features(spark, fx):
    df = fx("kmeans_customers")
    extra = df.limit(2).selectExpr("concat('X', customer_id) as customer_id", *[
        f"cast(null as {t}) as {c}" if c == "annual_spend" else c for c, t in df.dtypes if c != "customer_id"])
    out = seg.kmeans_segments(df.unionByName(extra, allowMissingColumns=True), seeds=(42, 43))
    assert out.count() == df.count() + 2
    assert out.where("segment is null").count() == 2
    counts = {r.segment: r["count"] for r in seg.segment_counts(out).collect()}
    assert counts[None] == 2 and sum(counts.values()) == df.count() + 2


def test_exact_kmeans_golden_and_missing(spark, fx):
    df = fx("kmeans_customers")
    extra = df.limit(2).selectExpr("concat('X', customer_id) as customer_id", *[
        f"cast(null as {t}) as {c}" if c == "annual_spend" else c for c, t in df.dtypes if c != "customer_id"])
    out = seg.exact_kmeans_segments(df.unionByName(extra, allowMissingColumns=True)).toPandas().set_index("customer_id").segment
    exp = golden("kmeans_segmented.csv").set_index("customer_id").segment
    assert out[~out.index.str.startswith("X")].sort_index().to_dict() == exp.sort_index().to_dict()
    assert out[out.index.str.startswith("X")].isna().all() and len(out) == df.count() + 2


def lloyd(points, centres, scale):
    """Plain Lloyd rounds to a fixed point."""
    def near(p):
        d = [sum(((a - b) / s)**2 for a, b, s in zip(p, c, scale)) for c in centres]
        return d.index(min(d))
    while True:
        own = [near(p) for p in points]
        fresh = []
        for c in range(len(centres)):
            mine = [p for p, o in zip(points, own) if o == c]
            fresh.append(tuple(sum(x) / len(mine) for x in zip(*mine)) if mine else centres[c])
        if fresh == centres:
            return own, centres
        centres = fresh


def random_points(seed, n=300):
    import random
    rnd = random.Random(seed)
    return [(round(rnd.gauss(100 * rnd.randrange(4), 20), 2), float(rnd.randrange(1, 30))) for _ in range(n)]


def test_exact_kmeans_is_a_fixed_point_and_ignores_partitions(spark):
    import statistics
    pts = random_points(4)
    df = spark.createDataFrame(pts, "annual_spend double, purchase_frequency double")
    fit = seg.fit_kmeans(df, df.columns, [1, 3, 5], "annual_spend")
    other = seg.fit_kmeans(df.repartition(7), df.columns, [1, 3, 5], "annual_spend")
    scale = [statistics.pstdev(x) for x in zip(*pts)]
    for k, got in fit.items():
        assert got == other[k] or [round(a, 9) for c in got.centres for a in c] == [round(a, 9) for c in other[k].centres for a in c]
        own, centres = lloyd(pts, got.centres, scale)
        assert [round(x, 6) for c in centres for x in c] == [round(x, 6) for c in got.centres for x in c]
        assert sorted(got.sizes) == sorted(own.count(c) for c in set(own)) and sum(got.sizes) == 300


def test_cluster_counts_equal_pairwise_silhouettes(spark):
    import statistics
    pts = random_points(9, 120)
    df = spark.createDataFrame(pts, "annual_spend double, purchase_frequency double")
    got = {r.k: r for r in seg.cluster_counts(df, ks=(2, 3, 4)).collect()}
    scale = [statistics.pstdev(x) for x in zip(*pts)]
    z = [tuple(x / s for x, s in zip(p, scale)) for p in pts]
    for k, r in got.items():
        own, centres = lloyd(pts, seg.fit_kmeans(df, df.columns, [k], "annual_spend")[k].centres, scale)
        total = 0.0
        for i, p in enumerate(z):
            per = {}
            for j, q in enumerate(z):
                if i != j:
                    per.setdefault(own[j], []).append(sum((a - b)**2 for a, b in zip(p, q)))
            if own[i] in per:
                a, b = statistics.fmean(per.pop(own[i])), min(statistics.fmean(x) for x in per.values())
                total += (b - a) / max(a, b)
        assert abs(r.silhouette - total / len(z)) < 1e-9
    assert got[2].bend is None and got[4].bend is None
    assert abs(got[3].bend - (got[2].inertia - 2 * got[3].inertia + got[4].inertia)) < 1e-9


def test_kmeans_of_few_equal_and_no_rows(spark):
    schema = "customer_id string, annual_spend double, purchase_frequency double"
    one = spark.createDataFrame([("a", 5.0, 1.0), ("b", 5.0, 1.0)], schema)
    assert len({r.segment for r in seg.exact_kmeans_segments(one).collect()}) == 1
    none = spark.createDataFrame([], schema)
    assert seg.exact_kmeans_segments(none).count() == 0 and seg.cluster_counts(none).count() == 0
    assert [r.silhouette for r in seg.cluster_counts(one, ks=(2, 3)).collect()] == [0.0, 0.0]


def test_a_round_adds_numbers_written_once(spark):
    """Sums of a task's rows on arrays equal those in SQL, the rows' decimals
    are made once and not in every round."""
    from pyspark.sql import functions as F
    pts = [(-1e12 + 0.123456, 3.0), (7.0000005, 3.0), (-0.0000004, 8.5), (2.5e11, -4.25)] + random_points(3, 200)
    f = ["annual_spend", "purchase_frequency"]
    df = spark.createDataFrame(pts, f"{f[0]} double, {f[1]} double").repartition(3)
    centres, scale = {2: [(0.0, 1.0), (5.0, 9.0)], 3: [(0.0, 1.0), (0.0, 1.0), (1e11, 2.0)]}, [1.5, 0.25]
    packed = df.select(*[x for i, c in enumerate(f) for x in seg._packed(c, i)])
    parts = [f"x{i}_{p}" for i in range(2) for p in seg.PARTS]
    got = {}
    for r in packed.mapInArrow(seg._cluster_sums(centres, scale), f"k int, c int, n long, {', '.join(f'{p} long' for p in parts)}").collect():
        got.setdefault((r.k, r.c), []).append(r)
    for k, own in centres.items():
        want = df.groupBy(seg._nearest(f, own, scale).c.alias("c")).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast(seg.EXACT)).alias(f"x{i}") for i, c in enumerate(f)]).collect()
        assert {c for kk, c in got if kk == k} == {r.c for r in want}
        for r in want:
            rows = got[k, r.c]
            assert sum(x.n for x in rows) == r.n
            for i in range(2):
                assert seg._unpacked(*[sum(x[f"x{i}_{p}"] for x in rows) for p in seg.PARTS]) == r[f"x{i}"]
