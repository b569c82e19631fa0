"""Customer segmentation: rule-based 2x2, RFM scoring and K-means (Q37-Q39).

The rule and RFM classifiers are native ``CASE WHEN`` chains (codegen, no
Python per row). K-means runs as aggregates of the rows from starts that the
data fix (``exact_kmeans_segments``), so its result can be restated in SQL, or in
MLlib from several random starts (``kmeans_segments``). ``cluster_counts`` helps
to choose how many clusters to look for.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from decimal import Context, Decimal
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.session import checkpointed

# Segment names; the classifiers' cuts are their parameters' defaults.
RULE_LABELS = {
    ("young", "high"): "Young High-Value",
    ("young", "low"): "Young Low-Value",
    ("mature", "high"): "Mature High-Value",
    ("mature", "low"): "Mature Low-Value",
}
RFM_SEGMENTS = [(8, "Champions"), (6, "Loyal Customers"), (4, "Needs Attention")]
RFM_FALLBACK = "Lost"
KMEANS_LABELS = ["Budget Shoppers", "Regular Shoppers", "Big Spenders"]


def rule_segments(df: DataFrame, age: str = "age", spend: str = "annual_spend",
                  young_below: float = 30, high_value_from: float = 500) -> DataFrame:
    """Q37: customer rows + ``segment``. A missing value compares as false
    (so a missing age counts as mature, a missing spend as low value)."""
    young = F.coalesce(F.col(age) < F.lit(young_below), F.lit(False))
    high = F.coalesce(F.col(spend) >= F.lit(high_value_from), F.lit(False))
    seg = (F.when(young & high, RULE_LABELS[("young", "high")])
           .when(young, RULE_LABELS[("young", "low")])
           .when(high, RULE_LABELS[("mature", "high")])
           .otherwise(RULE_LABELS[("mature", "low")]))
    return df.withColumn("segment", seg)


def _score_at_most(x: Column, cuts: Sequence[float]) -> Column:
    """3 if x <= cuts[0], 2 if x <= cuts[1], else 1 (missing -> 1)."""
    return F.when(x <= cuts[0], 3).when(x <= cuts[1], 2).otherwise(1)


def _score_at_least(x: Column, cuts: Sequence[float]) -> Column:
    """3 if x >= cuts[0], 2 if x >= cuts[1], else 1 (missing -> 1)."""
    return F.when(x >= cuts[0], 3).when(x >= cuts[1], 2).otherwise(1)


def rfm_segments(df: DataFrame, recency: str = "recency_days", frequency: str = "frequency",
                 monetary: str = "monetary", recency_cuts: Sequence[float] = (30, 150),
                 frequency_cuts: Sequence[float] = (10, 4),
                 monetary_cuts: Sequence[float] = (1000, 300)) -> DataFrame:
    """Q38: r/f/m scores (1-3), their total and the named segment."""
    out = df.select("*",
                    _score_at_most(F.col(recency), recency_cuts).cast("long").alias("r_score"),
                    _score_at_least(F.col(frequency), frequency_cuts).cast("long").alias("f_score"),
                    _score_at_least(F.col(monetary), monetary_cuts).cast("long").alias("m_score"))
    out = out.withColumn("rfm_total", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    seg = None
    for floor, name in RFM_SEGMENTS:
        cond = F.col("rfm_total") >= floor
        seg = F.when(cond, name) if seg is None else seg.when(cond, name)
    return out.withColumn("segment", seg.otherwise(RFM_FALLBACK))


def segment_counts(df: DataFrame, segment: str = "segment") -> DataFrame:
    """Category counts, largest first."""
    return (df.groupBy(segment).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.col(segment)))


def kmeans_segments(df: DataFrame, features: Sequence[str] = ("annual_spend", "purchase_frequency"),
                    k: int = 3, labels: Sequence[str] = KMEANS_LABELS, seeds: Sequence[int] = tuple(range(42, 52)),
                    order_by: str | None = None, max_iter: int = 300) -> DataFrame:
    """Q39: standardise features, fit K-means from ten starts until the
    centres stand still (keeping the lowest training cost), and name clusters
    by ascending mean of ``order_by`` (default: the first feature). Rows with
    a missing feature keep a NULL segment. Raw cluster ids are dropped."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    if len(labels) != k:
        raise ValueError(f"need exactly {k} labels, got {len(labels)}")
    order_by = order_by or features[0]
    whole = F.lit(True)
    for f in features:
        whole = whole & F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
    # written once to the shared folder: every start and the result read it,
    # and nothing stays cached in executors
    rows = checkpointed(df.withColumn("_whole", whole))
    assembled = VectorAssembler(inputCols=list(features), outputCol="_raw").transform(rows.where("_whole"))
    scaler = StandardScaler(inputCol="_raw", outputCol="_features", withMean=True, withStd=True)
    scaled = scaler.fit(assembled).transform(assembled)

    def fit(seed: int):
        model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="_cluster",
                       maxIter=max_iter, tol=0.0).fit(scaled)
        return model.summary.trainingCost, seed, model

    # starts are independent distributed fits
    with ThreadPoolExecutor(max_workers=len(seeds)) as pool:
        fits = list(pool.map(fit, seeds))
    best = min(fits, key=lambda f: (f[0], f[1]))
    pred = best[2].transform(scaled)
    # k rows: rank clusters by the mean of the ordering column
    means = pred.groupBy("_cluster").agg(F.avg(order_by).alias("_m"))
    ranked = means.select("_cluster", F.row_number().over(Window.orderBy("_m", "_cluster")).alias("_r"))
    name = None
    for i, lab in enumerate(labels, start=1):
        name = F.when(F.col("_r") == i, lab) if name is None else name.when(F.col("_r") == i, lab)
    named = (pred.join(F.broadcast(ranked.select("_cluster", name.alias("segment"))), "_cluster")
             .drop("_raw", "_features", "_cluster", "_whole"))
    missing = rows.where(~F.col("_whole")).drop("_whole").withColumn("segment", F.lit(None).cast("string"))
    return named.unionByName(missing)


# --------------------------------------------------------------------------- exact k-means (M2), choice of k (M4)
START_BINS = 1000
EXACT = "decimal(24,6)"        # features are summed in it, so sums don't depend on the order of rows
EXACTLY = Context(prec=60)


@dataclass
class Clusters:
    """Centres of k clusters in the features' own units, by ascending first
    centre coordinate of ``order_by``; ``scale`` holds each feature's standard
    deviation (1 for a constant one)."""
    centres: list[tuple[float, ...]]
    scale: list[float]
    sizes: list[int]
    rounds: int


def _whole(features: Sequence[str]) -> Column:
    whole = F.lit(True)
    for f in features:
        whole = whole & F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
    return whole


def _nearest(features: Sequence[str], centres: Sequence[Sequence[float]], scale: Sequence[float]) -> Column:
    """``(d, c)``: the least squared distance to a centre, in units of
    ``scale``, and the number of that centre, the first of several."""
    def distance(centre: Column, number: Column) -> Column:
        steps = [(F.col(f).cast("double") - centre[i]) / F.lit(float(s)) for i, (f, s) in enumerate(zip(features, scale))]
        return F.struct(sum((x * x for x in steps[1:]), steps[0] * steps[0]).alias("d"), number.alias("c"))

    known = F.array(*[F.array(*[F.lit(float(v)) for v in centre]) for centre in centres])
    return F.array_min(F.transform(known, distance))


PARTS = ("high", "low", "rest")     # of a feature in EXACT: its whole part in units of 2^32, below that, and millionths


def _packed(feature: str, i: int) -> list[Column]:
    """A feature as it is compared, a double, and as it is summed, in three
    longs, so that a round adds integers and not decimals."""
    exact = F.col(feature).cast(EXACT)
    whole = F.floor(exact).cast("long")
    rest = ((exact - F.floor(exact)) * 1_000_000).cast("long")
    return [F.col(feature).cast("double").alias(f"v{i}"), F.shiftright(whole, 32).alias(f"x{i}_high"),
            whole.bitwiseAND(F.lit((1 << 32) - 1)).alias(f"x{i}_low"), rest.alias(f"x{i}_rest")]


def _unpacked(high: Decimal, low: Decimal, rest: Decimal) -> Decimal:
    """The sum of a feature from those of its parts."""
    return EXACTLY.scaleb(Decimal((int(high) << 32) + int(low)) * 1_000_000 + Decimal(int(rest)), -6)


def _cluster_sums(centres: dict[int, list[tuple[float, ...]]], scale: list[float]):
    """Counts and sums of each cluster of each k over a task's rows: the
    arithmetic of ``_nearest`` on arrays."""
    def run(batches):
        total: dict[tuple[int, int], list[int]] = {}
        d = len(scale)
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 20):      # sums of parts of fewer than 2^21 rows are exact in doubles
                part = batch.slice(at, 1 << 20)
                v = [part.column(f"v{i}").to_numpy() for i in range(d)]
                sums = [part.column(f"x{i}_{p}").to_numpy().astype(np.float64) for i in range(d) for p in PARTS]
                known: dict[tuple[float, ...], np.ndarray] = {}
                for k, own in centres.items():
                    best = np.zeros(part.num_rows, np.int64)
                    least = None
                    for c, centre in enumerate(own):
                        far = known.get(centre)
                        if far is None:
                            for i in range(d):
                                step = (v[i] - centre[i]) / scale[i]
                                far = step * step if i == 0 else far + step * step
                            known[centre] = far
                        if least is None:
                            least = far.copy()
                        else:
                            best[far < least] = c
                            np.minimum(least, far, out=least)
                    n = np.bincount(best, minlength=len(own))
                    per = [np.bincount(best, w, len(own)) for w in sums]
                    for c in np.flatnonzero(n).tolist():
                        held = total.setdefault((k, c), [0] * (1 + len(sums)))
                        for j, x in enumerate([n, *per]):
                            held[j] += int(x[c])
        names = ["k", "c", "n", *(f"x{i}_{p}" for i in range(d) for p in PARTS)]
        cols = list(zip(*[(k, c, *held) for (k, c), held in total.items()])) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32() if j < 2 else pa.int64()) for j, x in enumerate(cols)], names=names)
    return run


def fit_kmeans(rows: DataFrame, features: Sequence[str], ks: Sequence[int], order_by: str) -> dict[int, Clusters]:
    """Lloyd's rounds for every k at once, each one aggregate of ``rows``
    (which have all features), until no centre moves. A task adds up its rows
    on arrays; the rows are written once, as numbers ready to be added.

    The start is fixed by the data: ``order_by`` is cut into ``START_BINS`` bins
    of one width, whose counts cut it into k cells of about equal size, and a
    cell's mean is a centre. Sums are exact, so a round that leaves all of them
    as they were is a fixed point, and the result does not depend on the
    partitioning. Only k sums a feature reach the driver."""
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.col(order_by).cast("double")).alias("lo"),
                     F.max(F.col(order_by).cast("double")).alias("hi"),
                     *[F.stddev_pop(F.col(f).cast("double")).alias(f"s{i}") for i, f in enumerate(features)]).collect()[0]
    if not stats["n"]:
        return {}
    scale = [stats[f"s{i}"] or 1.0 for i in range(len(features))]
    sums = [F.sum(F.col(f).cast(EXACT)).alias(f"x{i}") for i, f in enumerate(features)]
    width = stats["hi"] - stats["lo"]
    at = F.floor((F.col(order_by).cast("double") - F.lit(stats["lo"])) * START_BINS / F.lit(width)) if width else F.lit(0)
    bins = rows.groupBy(F.least(F.lit(START_BINS - 1), at).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), *sums).orderBy("bin").collect()                     # at most START_BINS rows

    def centre(rs) -> tuple[float, ...]:
        n = sum(r["n"] for r in rs)
        return tuple(float(sum(r[f"x{i}"] for r in rs)) / n for i in range(len(features)))

    now: dict[int, list[tuple[float, ...]]] = {}
    for k in ks:
        before = [0, *accumulate(r["n"] for r in bins)]
        cells: dict[int, list] = {}
        for r, b in zip(bins, before):
            cells.setdefault((2 * b + r["n"]) * k // (2 * stats["n"]), []).append(r)
        now[k] = [centre(rs) for _, rs in sorted(cells.items())]       # a cell without rows gives no centre
    done: dict[int, Clusters] = {}
    seen: dict[int, dict] = {}
    rounds = 0
    packed = checkpointed(rows.select(*[x for i, f in enumerate(features) for x in _packed(f, i)]))
    parts = [f"x{i}_{p}" for i in range(len(features)) for p in PARTS]
    schema = f"k int, c int, n long, {', '.join(f'{p} long' for p in parts)}"
    while len(done) < len(now):
        rounds += 1
        open_ks = [k for k in now if k not in done]
        got: dict[int, dict] = {k: {} for k in open_ks}
        each = packed.mapInArrow(_cluster_sums({k: now[k] for k in open_ks}, scale), schema)
        for r in each.groupBy("k", "c").agg(F.sum("n").alias("n"), *[F.sum(F.col(p).cast("decimal(20,0)")).alias(p) for p in parts]).collect():
            got[r["k"]][r["c"]] = {"n": r["n"], **{f"x{i}": _unpacked(*[r[f"x{i}_{p}"] for p in PARTS]) for i in range(len(features))}}
        for k in open_ks:
            state = {c: tuple(r[f] for f in ("n", *(f"x{i}" for i in range(len(features))))) for c, r in got[k].items()}
            now[k] = [centre([got[k][c]]) if c in got[k] else old for c, old in enumerate(now[k])]
            if seen.get(k) == state:
                done[k] = Clusters(now[k], scale, [state.get(c, (0,))[0] for c in range(len(now[k]))], rounds)
            seen[k] = state
    return done


def exact_kmeans_segments(df: DataFrame, features: Sequence[str] = ("annual_spend", "purchase_frequency"),
                          k: int = 3, labels: Sequence[str] = KMEANS_LABELS, order_by: str | None = None) -> DataFrame:
    """Q39 from a start that the data fix: rows + ``segment``, clusters named by
    ascending mean of ``order_by`` (default: the first feature). Rows with a
    missing feature keep a NULL segment."""
    if len(labels) != k:
        raise ValueError(f"need exactly {k} labels, got {len(labels)}")
    order_by = order_by or features[0]
    rows = checkpointed(df.withColumn("_whole", _whole(features)))
    fitted = fit_kmeans(rows.where("_whole"), features, [k], order_by).get(k)
    if fitted is None:
        return rows.drop("_whole").withColumn("segment", F.lit(None).cast("string"))
    at = list(features).index(order_by)
    order = sorted(range(len(fitted.centres)), key=lambda c: (fitted.centres[c][at], c))
    name = F.lit(None).cast("string")
    for label, c in zip(labels, order):
        name = F.when(F.col("_cluster") == c, label).otherwise(name)
    cluster = F.when(F.col("_whole"), _nearest(features, fitted.centres, fitted.scale).c)
    return rows.withColumn("_cluster", cluster).withColumn("segment", name).drop("_cluster", "_whole")


def cluster_counts(df: DataFrame, features: Sequence[str] = ("annual_spend", "purchase_frequency"),
                   ks: Sequence[int] = tuple(range(2, 9)), order_by: str | None = None) -> DataFrame:
    """M4: one row per k, to choose from: ``(k, inertia, silhouette, bend)``.

    ``inertia`` is the sum of squared distances to the centres in standardised
    units, ``bend`` its second difference (large where the curve has its elbow;
    NULL at both ends), ``silhouette`` the mean over all rows. A row's mean
    squared distance to a cluster follows from the cluster's count, sum vector
    and sum of squared lengths, so one scan gives the moments of all clusters of
    all k, a second one the sums, and no two rows are ever paired."""
    order_by = order_by or features[0]
    rows = checkpointed(df.select(*features).where(_whole(features)))
    fits = fit_kmeans(rows, features, ks, order_by)
    schema = "k int, inertia double, silhouette double, bend double"
    if not fits:
        return df.sparkSession.createDataFrame([], schema)
    scale = next(iter(fits.values())).scale
    z = [F.col(f).cast("double") / F.lit(s) for f, s in zip(features, scale)]
    length2 = sum((x * x for x in z[1:]), z[0] * z[0])
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), _nearest(features, c.centres, scale).c.alias("c"))
                               for k, c in fits.items()])).alias("to")
    moments: dict[int, dict[int, tuple]] = {k: {} for k in fits}
    per = rows.select(each, length2.alias("q"), *[x.alias(f"z{i}") for i, x in enumerate(z)]).groupBy("to.k", "to.c").agg(
        F.count(F.lit(1)).alias("n"), F.sum("q").alias("q"), *[F.sum(f"z{i}").alias(f"z{i}") for i in range(len(z))])
    for r in per.collect():                                                        # a row per cluster
        moments[r["k"]][r["c"]] = (r["n"], r["q"] / r["n"], [r[f"z{i}"] / r["n"] for i in range(len(z))])

    def silhouette(k: int, own: Column) -> Column:
        """From the mean squared distances to the rows of each cluster; 0 in a
        cluster of one row, or beside no other."""
        known = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(n).alias("n"), F.lit(q).alias("q"),
                                   F.array(*[F.lit(v) for v in mean]).alias("mean"))
                          for c, (n, q, mean) in sorted(moments[k].items())])

        def to(m: Column) -> Column:
            dot = sum((x * m["mean"][i + 1] for i, x in enumerate(z[1:])), z[0] * m["mean"][0])
            return F.greatest(F.lit(0.0), length2 - 2 * dot + m["q"])

        # the row itself left out of its own cluster
        mine = F.transform(F.filter(known, lambda m: (m["c"] == own) & (m["n"] > 1)), lambda m: to(m) * m["n"] / (m["n"] - 1))
        a, b = F.array_min(mine), F.array_min(F.transform(F.filter(known, lambda m: m["c"] != own), to))
        return F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0))

    # a column for each k's nearest centre, each used twice
    near = rows.select("*", *[_nearest(features, fit.centres, scale).alias(f"_{k}") for k, fit in fits.items()])
    sums = [x for k in fits for x in (F.sum(f"_{k}.d").alias(f"i{k}"), F.avg(silhouette(k, F.col(f"_{k}.c"))).alias(f"s{k}"))]
    got = near.agg(*sums).collect()[0]
    out = []
    for k in sorted(fits):
        bend = got[f"i{k - 1}"] - 2 * got[f"i{k}"] + got[f"i{k + 1}"] if k - 1 in fits and k + 1 in fits else None
        out.append((k, got[f"i{k}"], got[f"s{k}"], bend))
    return df.sparkSession.createDataFrame(out, schema)


# executors need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
