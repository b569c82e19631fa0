"""Query catalog: one entry per user-level operator, bound to
the driver tables. Each entry is ``(spark, sf_dir) -> DataFrame``; doubles are
rounded to 6 decimals at the edge so engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions.common import round_doubles
from meridian.functions.intervals import match_bands
from meridian.operators import cac, cohort, cuped, identity, rdd, segmentation, switchback
from meridian.plans import bindings as B
from meridian.sources import infer

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


# --------------------------------------------------------------------------- RDD (B7)
RDD_CUTOFF = 5000.0
RDD_BAND_EDGES = [-1000, 0, 2000, 4000, 5000, 6000, 8000, 10000]
RDD_BAND_LABELS = ["-1000--1", "0-1999", "2000-3999", "4000-4999", "5000-5999",
                   "6000-7999", "8000+"]


@query("rdd_band_summary")
def q_rdd_band_summary(spark, sf_dir):
    return rdd.band_summary(B.rdd_customers(spark, sf_dir), edges=RDD_BAND_EDGES,
                            labels=RDD_BAND_LABELS, digits=None)


@query("rdd_estimate")
def q_rdd_estimate(spark, sf_dir):
    return rdd.discontinuity_estimate(B.rdd_customers(spark, sf_dir), bandwidth=1000,
                                      cutoff=RDD_CUTOFF)


@query("rdd_density_check")
def q_rdd_density_check(spark, sf_dir):
    return rdd.density_check(B.rdd_customers(spark, sf_dir), bin_width=500, cutoff=RDD_CUTOFF)


@query("rdd_placebo")
def q_rdd_placebo(spark, sf_dir):
    return rdd.placebo_cutoffs(B.rdd_customers(spark, sf_dir),
                               fake_cutoffs=(3000, 4000, 6500, 8000), bandwidth=500)


@query("rdd_bandwidth_sensitivity")
def q_rdd_bandwidth_sensitivity(spark, sf_dir):
    return rdd.bandwidth_sensitivity(B.rdd_customers(spark, sf_dir),
                                     bandwidths=(250, 500, 1000, 1500, 2000), cutoff=RDD_CUTOFF)


@query("rdd_sweep")
def q_rdd_sweep(spark, sf_dir):
    """Ten thousand windows: a hundred cutoffs by a hundred bandwidths. Counts
    and sums to the cent, which are exact; means of so many windows hold
    half-way cases of any number of digits."""
    grid = spark.range(10_000).selectExpr("cast(50 * (id div 100) as double) as cutoff",
                                          "cast(20 * (id % 100) + 20 as double) as bandwidth")
    cents = B.rdd_customers(spark, sf_dir).withColumn("annual_spend", F.round("annual_spend", 2))
    return rdd.sweep(cents, grid).select("cutoff", "bandwidth", "n_below", "n_above", "sum_below", "sum_above")


def _band_table(spark):
    """Ten thousand overlapping bands over the whole running variable."""
    return spark.range(10_000).selectExpr("id as band_id", "cast(id * 11 div 10 - 1000 as double) as lo",
                                          "cast(id * 11 div 10 - 1000 + shiftleft(1, cast(id % 5 as int)) as double) as hi")


@query("rdd_band_rows")
def q_rdd_band_rows(spark, sf_dir):
    """Every customer with each of the bands that hold it."""
    return match_bands(B.rdd_customers(spark, sf_dir).select("customer_id", "points_score"), _band_table(spark), "points_score")


@query("rdd_band_table")
def q_rdd_band_table(spark, sf_dir):
    cents = B.rdd_customers(spark, sf_dir).withColumn("annual_spend", F.round("annual_spend", 2))
    return rdd.band_table_summary(cents, _band_table(spark)).select("band_id", "lo", "hi", "n", "total")


# --------------------------------------------------------------------------- types found in text (S1, S2)
REJECT_SHARE = 0.05


@query("text_types")
def q_text_types(spark, sf_dir):
    """What each column of the orders holds when read as text, the type it gets
    and how many cells don't fit that."""
    raw = B.orders_text(spark, sf_dir)
    profile = infer.column_profile(raw).withColumn("type", infer.chosen(REJECT_SHARE))
    typed = infer.typed_with_rejects(raw, infer.choose_types(profile, REJECT_SHARE))
    return (profile.join(infer.reject_counts(typed), "column", "left")
            .withColumn("n_rejected", F.coalesce("n_rejected", F.lit(0).cast("long"))))


@query("text_rejects")
def q_text_rejects(spark, sf_dir):
    """The orders with a cell that doesn't fit, and the columns in question."""
    raw = B.orders_text(spark, sf_dir)
    typed = infer.typed_with_rejects(raw, infer.choose_types(infer.column_profile(raw), REJECT_SHARE))
    return typed.rejects.select("o_orderkey", F.array_join("_rejected", ";").alias("rejected"))


# --------------------------------------------------------------------------- CAC (B8, B9)
@query("nominal_cac")
def q_nominal_cac(spark, sf_dir):
    return cac.nominal_cac(B.cac_spend(spark, sf_dir))


@query("ramp_curve")
def q_ramp_curve(spark, sf_dir):
    return cac.ramp_curve(B.host_ramp(spark, sf_dir))


@query("ramp_shortfall")
def q_ramp_shortfall(spark, sf_dir):
    return cac.ramp_shortfall(B.host_ramp(spark, sf_dir))


@query("effective_cac")
def q_effective_cac(spark, sf_dir):
    return cac.effective_cac(B.cac_spend(spark, sf_dir), B.host_ramp(spark, sf_dir))


@query("churn_replacement_cost")
def q_churn_replacement_cost(spark, sf_dir):
    return cac.churn_replacement_cost(B.cac_spend(spark, sf_dir), B.host_ramp(spark, sf_dir))


@query("ramp_compression_projection")
def q_ramp_compression_projection(spark, sf_dir):
    return cac.ramp_compression(B.host_ramp(spark, sf_dir), compression=0.5)


# --------------------------------------------------------------------------- segmentation (B10-B12)
RFM_CUTS = dict(recency_cuts=(100, 260), frequency_cuts=(11, 8), monetary_cuts=(2.8e6, 2.05e6))


@query("segment_rules")
def q_segment_rules(spark, sf_dir):
    return segmentation.rule_segments(B.rule_customers(spark, sf_dir), young_below=30,
                                      high_value_from=5000)


@query("segment_rules_counts")
def q_segment_rules_counts(spark, sf_dir):
    return segmentation.segment_counts(
        segmentation.rule_segments(B.rule_customers(spark, sf_dir), young_below=30, high_value_from=5000))


@query("segment_rfm")
def q_segment_rfm(spark, sf_dir):
    return segmentation.rfm_segments(B.rfm_customers(spark, sf_dir), **RFM_CUTS)


@query("segment_rfm_counts")
def q_segment_rfm_counts(spark, sf_dir):
    return segmentation.segment_counts(segmentation.rfm_segments(B.rfm_customers(spark, sf_dir), **RFM_CUTS))


@query("segment_kmeans")
def q_segment_kmeans(spark, sf_dir):
    return segmentation.exact_kmeans_segments(B.kmeans_customers(spark, sf_dir)).select(
        "customer_id", "annual_spend", "purchase_frequency", "segment")


@query("segment_kmeans_counts")
def q_segment_kmeans_counts(spark, sf_dir):
    return segmentation.segment_counts(segmentation.exact_kmeans_segments(B.kmeans_customers(spark, sf_dir)))


@query("segment_kmeans_starts")
def q_segment_kmeans_starts(spark, sf_dir):
    """The fit from ten random starts (MLlib), which has no counterpart in SQL."""
    return segmentation.segment_counts(segmentation.kmeans_segments(B.kmeans_customers(spark, sf_dir)))


@query("segment_kmeans_choice")
def q_segment_kmeans_choice(spark, sf_dir):
    return segmentation.cluster_counts(B.kmeans_customers(spark, sf_dir), ks=tuple(range(2, 9)))


# --------------------------------------------------------------------------- CUPED (B5)
@query("cuped_theta")
def q_cuped_theta(spark, sf_dir):
    return cuped.cuped_theta(B.cuped_users(spark, sf_dir))


@query("cuped_adjusted")
def q_cuped_adjusted(spark, sf_dir):
    return cuped.cuped_adjusted(B.cuped_users(spark, sf_dir))


@query("cuped_ttest")
def q_cuped_ttest(spark, sf_dir):
    return cuped.cuped_ttest(B.cuped_users(spark, sf_dir), with_p=False)


@query("cuped_ttest_pvalue")
def q_cuped_ttest_pvalue(spark, sf_dir):
    return cuped.cuped_ttest(B.cuped_users(spark, sf_dir), with_p=True)


# --------------------------------------------------------------------------- switchback (B6)
SB = dict(head_minutes=240, tail_minutes=240, block_minutes=1440)
SB_WASHOUT = 240


def _sb(spark, sf_dir):
    return B.switchback_intervals(spark, sf_dir).drop("ts")


@query("cuped_ttest_no_adjust")
def q_cuped_ttest_no_adjust(spark, sf_dir):
    return cuped.cuped_ttest(B.cuped_users_sparse(spark, sf_dir), missing_x="no_adjust", with_p=False)


@query("switchback_naive")
def q_switchback_naive(spark, sf_dir):
    return switchback.naive_pooled_lift(_sb(spark, sf_dir))


@query("switchback_washout")
def q_switchback_washout(spark, sf_dir):
    return switchback.washout_summary(_sb(spark, sf_dir), SB_WASHOUT)


@query("switchback_washed")
def q_switchback_washed(spark, sf_dir):
    return switchback.apply_washout(_sb(spark, sf_dir), SB_WASHOUT)


@query("interval_preagg")
def q_interval_preagg(spark, sf_dir):
    return switchback.interval_preagg(_sb(spark, sf_dir), interval_minutes=5)


@query("switchback_block_lift")
def q_switchback_block_lift(spark, sf_dir):
    return switchback.block_level_lift(switchback.apply_washout(_sb(spark, sf_dir), SB_WASHOUT))


@query("switchback_zone_lift")
def q_switchback_zone_lift(spark, sf_dir):
    return switchback.zone_level_lift(switchback.apply_washout(_sb(spark, sf_dir), SB_WASHOUT))


@query("carryover_diagnostic")
def q_carryover_diagnostic(spark, sf_dir):
    return switchback.carryover_diagnostic(_sb(spark, sf_dir), **SB)


@query("carryover_curve")
def q_carryover_curve(spark, sf_dir):
    return switchback.carryover_curve(_sb(spark, sf_dir), interval_minutes=60)


# --------------------------------------------------------------------------- cohort (B4)
# every signup cohort in the data; observation ends at the last data month
COHORT: dict = {}


def _months(spark, sf_dir) -> tuple[str, str]:
    return B.orders_range(spark, sf_dir)[:2]


@query("retention_matrix")
def q_retention_matrix(spark, sf_dir):
    return cohort.retention_matrix(B.host_cohort_events(spark, sf_dir), _months(spark, sf_dir)[1], max_tenure=12, **COHORT)


@query("retention_at_tenure")
def q_retention_at_tenure(spark, sf_dir):
    return cohort.retention_at_tenure(B.host_cohort_events(spark, sf_dir), _months(spark, sf_dir)[1], tenure=1, **COHORT)


@query("blended_active_rate")
def q_blended_active_rate(spark, sf_dir):
    first, last = _months(spark, sf_dir)
    return cohort.blended_active_rate(B.host_cohort_events(spark, sf_dir), first_cohort=first, as_of=last, **COHORT)


@query("vintage_decline")
def q_vintage_decline(spark, sf_dir):
    return cohort.vintage_decline(B.host_cohort_events(spark, sf_dir), _months(spark, sf_dir)[1], tenure=1,
                                  min_consecutive=3, drop_threshold=1.0, **COHORT)


@query("mix_shift_projection")
def q_mix_shift_projection(spark, sf_dir):
    return cohort.mix_shift_projection(B.host_cohort_events(spark, sf_dir), _months(spark, sf_dir)[1],
                                       recovered_rate=96, new_cohort_size=800, **COHORT)


# --------------------------------------------------------------------------- identity (B1-B3)
def _staged(spark, sf_dir):
    return identity.stage(B.crm(spark, sf_dir), B.online(spark, sf_dir), B.pos(spark, sf_dir))


def _views(spark, sf_dir) -> identity.Views:
    """The first query that needs a table of the resolution stores it, all
    others of the session read it."""
    return identity.Views(B.crm(spark, sf_dir), B.online(spark, sf_dir), B.pos(spark, sf_dir))


@query("identity_normalise")
def q_identity_normalise(spark, sf_dir):
    return identity.all_records(_staged(spark, sf_dir))


@query("identity_edges")
def q_identity_edges(spark, sf_dir):
    st = _views(spark, sf_dir).staged
    return identity.star_edges(identity.all_records(st), receipts=identity.receipt_rows(st.pos))


@query("identity_components")
def q_identity_components(spark, sf_dir):
    return _views(spark, sf_dir).components


@query("identity_ids")
def q_identity_ids(spark, sf_dir):
    return _views(spark, sf_dir).ids


@query("match_quality")
def q_match_quality(spark, sf_dir):
    return identity.match_quality(_views(spark, sf_dir).detail)


@query("best_identity")
def q_best_identity(spark, sf_dir):
    return identity.best_identity(None, None, detail=_views(spark, sf_dir).detail)


@query("channel_activity")
def q_channel_activity(spark, sf_dir):
    return identity.channel_activity(None, None, detail=_views(spark, sf_dir).detail)


@query("customer_360")
def q_customer_360(spark, sf_dir):
    return _views(spark, sf_dir).customers


@query("customer_records")
def q_customer_records(spark, sf_dir):
    return identity.customer_records(_views(spark, sf_dir).ids)


@query("customer_record_lists")
def q_customer_record_lists(spark, sf_dir):
    return _views(spark, sf_dir).lists


@query("record_list_check")
def q_record_list_check(spark, sf_dir):
    v = _views(spark, sf_dir)
    return identity.list_check(v.lists, v.ids)


@query("id_crosswalk")
def q_id_crosswalk(spark, sf_dir):
    v = _views(spark, sf_dir)
    return identity.id_crosswalk(v.ids, v.customers)


@query("id_crosswalk_from_lists")
def q_id_crosswalk_from_lists(spark, sf_dir):
    """The crosswalk from nothing but the stored views: lists split back."""
    v = _views(spark, sf_dir)
    return identity.id_crosswalk(identity.split_lists(v.lists), v.customers)


@query("identity_completeness")
def q_identity_completeness(spark, sf_dir):
    v = _views(spark, sf_dir)
    return identity.completeness(v.staged, v.ids, v.customers)


FLAGSHIP = "customer_360"
