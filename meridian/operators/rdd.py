"""Regression discontinuity operators (Q26-Q30).

All operators are single-scan aggregates. Parameter sweeps (placebo cutoffs,
bandwidths) and the density histogram are one global aggregate holding a
conditional count/mean per parameter (or bin), unpivoted afterwards: the data
is read once for the whole sweep instead of once per parameter, and nothing
but one row per partition is shuffled. For thousands of (cutoff, bandwidth) pairs
``sweep`` takes differences of prefix sums instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.session import checkpointed

# Default band edges and labels for the points-score case study.
DEFAULT_BAND_EDGES = [7000, 8000, 9000, 9500, 10000, 10500, 11000, 12000, 15000]
DEFAULT_BAND_LABELS = ["7000-7999", "8000-8999", "9000-9499", "9500-9999",
                       "10000-10499", "10500-10999", "11000-11999", "12000+"]
DEFAULT_CUTOFF = 10000
DEFAULT_PLACEBO_CUTOFFS = (8000, 9000, 11500, 12000)
DEFAULT_BANDWIDTHS = (250, 500, 1000, 1500, 2000)


def band_expr(x: Column, edges: Sequence[float], labels: Sequence[str]) -> tuple[Column, Column]:
    """Half-open ``[a, b)`` binning to labelled bands; out of range -> NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per band")
    label, order = None, None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = (x >= F.lit(lo)) & (x < F.lit(hi))
        label = F.when(cond, F.lit(labels[i])) if label is None else label.when(cond, F.lit(labels[i]))
        order = F.when(cond, F.lit(i)) if order is None else order.when(cond, F.lit(i))
    return label, order


def band_summary(df: DataFrame, running: str = "points_score", outcome: str = "annual_spend",
                 edges: Sequence[float] = DEFAULT_BAND_EDGES,
                 labels: Sequence[str] = DEFAULT_BAND_LABELS, digits: int | None = 2) -> DataFrame:
    """Q26: ``(band, band_order, n, avg_spend)`` over half-open bands."""
    label, order = band_expr(F.col(running), edges, labels)
    avg = F.avg(outcome)
    out = (df.select(label.alias("band"), order.alias("band_order"), F.col(outcome))
           .where(F.col("band").isNotNull())
           .groupBy("band", "band_order")
           .agg(F.count(outcome).alias("n"),
                (F.round(avg, digits) if digits is not None else avg).alias("avg_spend")))
    return out


def _estimates(df: DataFrame, pairs: Sequence[tuple[float, float]], running: str,
               outcome: str) -> DataFrame:
    """One global aggregate with conditional moments per (cutoff, bandwidth)
    pair, unpivoted to one row per pair. The data is scanned once and the
    partial aggregates stay inside whole-stage codegen; no join is needed."""
    x, y = F.col(running), F.col(outcome)
    aggs, rows = [], []
    for i, (c, b) in enumerate(pairs):
        inside = (x >= F.lit(c - b)) & (x < F.lit(c + b))
        below, above = inside & (x < F.lit(c)), inside & (x >= F.lit(c))
        # n counts rows in the window (a missing outcome still counts); means skip it
        aggs += [F.count(F.when(below, F.lit(1))).alias(f"nb{i}"), F.count(F.when(above, F.lit(1))).alias(f"na{i}"),
                 F.avg(F.when(below, y)).alias(f"mb{i}"), F.avg(F.when(above, y)).alias(f"ma{i}")]
        rows.append(F.struct(F.lit(float(c)).alias("cutoff"), F.lit(float(b)).alias("bandwidth"),
                             F.col(f"nb{i}").alias("n_below"), F.col(f"na{i}").alias("n_above"),
                             F.col(f"mb{i}").alias("below_mean"), F.col(f"ma{i}").alias("above_mean"),
                             (F.col(f"ma{i}") - F.col(f"mb{i}")).alias("estimate")))
    # the hull of all windows is a plain range, which reaches the scan
    hull = df.where((x >= F.lit(min(c - b for c, b in pairs))) & (x < F.lit(max(c + b for c, b in pairs))))
    return hull.agg(*aggs).select(F.inline(F.array(*rows)))


def discontinuity_estimate(df: DataFrame, bandwidth: float = 1000, cutoff: float = DEFAULT_CUTOFF,
                           running: str = "points_score", outcome: str = "annual_spend") -> DataFrame:
    """Q27: mean outcome just above minus just below the cutoff in ``[c-b, c+b)``."""
    return _estimates(df, [(cutoff, bandwidth)], running, outcome)


def placebo_cutoffs(df: DataFrame, fake_cutoffs: Sequence[float] = DEFAULT_PLACEBO_CUTOFFS,
                    bandwidth: float = 500, running: str = "points_score",
                    outcome: str = "annual_spend") -> DataFrame:
    """Q29: the Q27 estimate at each placebo cutoff, in one scan."""
    return _estimates(df, [(c, bandwidth) for c in fake_cutoffs], running, outcome)


def bandwidth_sensitivity(df: DataFrame, bandwidths: Sequence[float] = DEFAULT_BANDWIDTHS,
                          cutoff: float = DEFAULT_CUTOFF, running: str = "points_score",
                          outcome: str = "annual_spend") -> DataFrame:
    """Q30: the Q27 estimate at each bandwidth, in one scan."""
    return _estimates(df, [(cutoff, b) for b in bandwidths], running, outcome)


def density_check(df: DataFrame, bin_width: float = 200, cutoff: float = DEFAULT_CUTOFF,
                  flag_ratio: float = 1.5, bins_per_side: int = 4,
                  running: str = "points_score") -> DataFrame:
    """Q28: histogram on ``2*bins_per_side`` equal-width bins around the cutoff.

    Bins are half-open except the last, which is closed on the right. The bin
    just below the cutoff is compared with the mean of the two bins further
    below it; ``suspicious`` flags only an excess below the cutoff.
    """
    nbins = 2 * bins_per_side
    lo = cutoff - bin_width * bins_per_side
    hi = lo + bin_width * nbins
    x = F.col(running)
    idx = F.least(F.floor((x - F.lit(lo)) / F.lit(bin_width)), F.lit(nbins - 1))
    in_range = (x >= F.lit(lo)) & (x <= F.lit(hi))
    # one pass: a conditional count per bin (empty bins count 0)
    counts = [F.count(F.when(in_range & (idx == i), F.lit(1))).alias(f"c{i}") for i in range(nbins)]
    just_below = bins_per_side - 1
    nbr = [i for i in (just_below - 1, just_below - 2) if i >= 0]
    nbr_avg = sum((F.col(f"c{i}") for i in nbr), F.lit(0)) / F.lit(len(nbr)) if nbr else F.lit(None)
    ratio = F.when(nbr_avg > 0, F.col(f"c{just_below}") / nbr_avg)
    rows = [F.struct(F.lit(i).cast("long").alias("bin_index"),
                     F.lit(f"{int(lo + i * bin_width)}-{int(lo + (i + 1) * bin_width) - 1}").alias("bin_label"),
                     F.col(f"c{i}").alias("count"),
                     F.lit(i == just_below).alias("is_just_below")) for i in range(nbins)]
    return (df.where(in_range).agg(*counts)
            .select(F.array(*rows).alias("_bins"), ratio.alias("ratio"),
                    F.coalesce(ratio > F.lit(flag_ratio), F.lit(False)).alias("suspicious"))
            .select(F.inline("_bins"), "ratio", "suspicious"))


# --------------------------------------------------------------------------- any number of windows
EXACT = "decimal(28,12)"        # outcomes are summed in it, so differences of sums lose nothing


def prefix_moments(df: DataFrame, points: DataFrame, running: str = "points_score",
                   outcome: str = "annual_spend", num_partitions: int | None = None) -> DataFrame:
    """``(x, n, ny, sy)`` for each distinct ``x`` of ``points``: rows of ``df``
    below it, those of them with an outcome, and the sum of these.

    Rows are first summed per running value. Values and points are then sorted
    together by range partitions and summed up within each; the totals of the
    partitions before (one row each) are added. So no point is looked up or
    joined, and no task holds more than a partition. Rows without a running
    value are in no window; an outcome that is NaN counts as missing."""
    spark = df.sparkSession
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    x, y = F.col(running).cast("double"), F.col(outcome).cast("double")
    y = F.when(~F.isnan(y), y).cast(EXACT)
    sums = ["n", "ny", "sy"]
    values = (df.where(x.isNotNull() & ~F.isnan(x)).groupBy(x.alias("x"))
              .agg(F.count(F.lit(1)).alias("n"), F.count(y).alias("ny"),
                   F.coalesce(F.sum(y), F.lit(0)).cast("decimal(38,12)").alias("sy")).withColumn("_point", F.lit(1)))
    # a point comes before the values that equal it: windows are half-open
    ends = points.select(F.col("x").cast("double").alias("x")).distinct().select(
        "x", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("ny"), F.lit(0).cast("decimal(38,12)").alias("sy"),
        F.lit(0).alias("_point"))
    placed = checkpointed(values.unionByName(ends).repartitionByRange(n_parts, "x", "_point")
                          .withColumn("_pid", F.spark_partition_id()))
    totals = sorted(tuple(r) for r in placed.groupBy("_pid").agg(*[F.sum(c).alias(c) for c in sums]).collect())
    before = accumulate([(0, 0, Decimal(0)), *(t[1:] for t in totals)], lambda a, b: tuple(u + v for u, v in zip(a, b)))
    offsets = spark.createDataFrame([(t[0], *b) for t, b in zip(totals, before)],
                                    "_pid int, _n long, _ny long, _sy decimal(38,12)")
    so_far = Window.partitionBy("_pid").orderBy("x", "_point").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.select("x", "_point", "_pid", *[F.sum(c).over(so_far).cast(placed.schema[c].dataType).alias(c) for c in sums])
    return (summed.where(F.col("_point") == 0).join(F.broadcast(offsets), "_pid")
            .select("x", *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in sums]))


def sweep(df: DataFrame, pairs: DataFrame, running: str = "points_score", outcome: str = "annual_spend",
          num_partitions: int | None = None) -> DataFrame:
    """The Q27 estimate for every row of ``pairs(cutoff, bandwidth)``, however
    many, from one pass over ``df``: each side of a window is a difference of two
    prefix sums. Equal to ``placebo_cutoffs`` and ``bandwidth_sensitivity``, with
    the exact sums of outcomes (``sum_below``, ``sum_above``) beside the means."""
    pairs = pairs.select(F.col("cutoff").cast("double").alias("cutoff"), F.col("bandwidth").cast("double").alias("bandwidth"))
    c, b = F.col("cutoff"), F.col("bandwidth")
    at = checkpointed(prefix_moments(df, pairs.select(F.explode(F.array(c - b, c, c + b)).alias("x")), running, outcome,
                                     num_partitions))

    def end(name: str, x: Column, rows: DataFrame) -> DataFrame:
        known = at.select(F.col("x").alias("_x"), F.struct("n", "ny", "sy").alias(name))
        return rows.withColumn("_x", x).join(known, "_x").drop("_x")

    met = end("hi", c + b, end("mid", c, end("lo", c - b, pairs)))

    def side(a: str, z: str) -> tuple[Column, Column, Column]:
        total = (F.col(f"{z}.sy") - F.col(f"{a}.sy")).cast("double")
        return F.col(f"{z}.n") - F.col(f"{a}.n"), total, F.try_divide(total, F.col(f"{z}.ny") - F.col(f"{a}.ny"))

    (n_below, sum_below, below), (n_above, sum_above, above) = side("lo", "mid"), side("mid", "hi")
    return met.select("cutoff", "bandwidth", n_below.alias("n_below"), n_above.alias("n_above"), below.alias("below_mean"),
                      above.alias("above_mean"), (above - below).alias("estimate"), sum_below.alias("sum_below"),
                      sum_above.alias("sum_above"))


def band_table_summary(df: DataFrame, bands: DataFrame, running: str = "points_score", outcome: str = "annual_spend",
                       num_partitions: int | None = None) -> DataFrame:
    """Q26 for a table of half-open bands ``(lo, hi, ...)`` of any length, which
    may overlap: ``n`` (rows with an outcome), ``total`` and ``avg`` beside the
    columns of ``bands``, from one pass over ``df``; bands without rows have a count of
    zero. Bands whose ends are null or NaN, or ``lo >= hi``, are left out."""
    lo, hi = F.col("lo").cast("double"), F.col("hi").cast("double")
    bands = bands.where((lo < hi) & ~F.isnan(lo) & ~F.isnan(hi))
    at = checkpointed(prefix_moments(df, bands.select(F.explode(F.array(lo, hi)).alias("x")), running, outcome, num_partitions))

    def end(name: str) -> DataFrame:
        return at.select(F.col("x").alias(f"_{name}"), F.struct("ny", "sy").alias(f"_at_{name}"))

    met = bands.withColumns({"_lo": lo, "_hi": hi}).join(end("lo"), "_lo").join(end("hi"), "_hi")
    n = F.col("_at_hi.ny") - F.col("_at_lo.ny")
    total = (F.col("_at_hi.sy") - F.col("_at_lo.sy")).cast("double")
    return met.select(*bands.columns, n.alias("n"), total.alias("total"), F.try_divide(total, n).alias("avg"))
