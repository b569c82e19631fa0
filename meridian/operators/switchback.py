"""Switchback experiment analysis (Q19-Q25).

A block is the unit of randomisation. Everything block-level is computed by
one aggregate on ``(zone, block_id)``; adjacency between blocks is a ``lag``
over each zone's blocks, so no self-join and no per-block scan is needed.
Per-zone windows run on block rows (one per block), not on raw intervals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.common import safe_div
from meridian.functions.stats import relative_lift, unpooled_t

# Arm labels (transition keys are "<previous> -> <current>").
CONTROL, TREATMENT = "Control", "Treatment"
TRANSITIONS = (f"{CONTROL} -> {TREATMENT}", f"{TREATMENT} -> {CONTROL}")


def _two_arm(df: DataFrame, value: str, arm: str, control: str, treatment: str, unit: str) -> DataFrame:
    aggs = []
    for tag, name in (("ctrl", control), ("trt", treatment)):
        on = F.col(arm) == name
        v = F.when(on, F.col(value))
        # n is the number of rows of the arm; mean and variance skip missing values
        aggs += [F.avg(v).alias(f"{tag}_mean"), F.count(F.when(on, F.lit(1))).alias(f"n_{tag}"),
                 F.var_samp(v).alias(f"_v_{tag}")]
    m = df.agg(*aggs)
    t = unpooled_t(F.col("n_ctrl"), F.col("ctrl_mean"), F.col("_v_ctrl"),
                   F.col("n_trt"), F.col("trt_mean"), F.col("_v_trt"))
    return m.select("ctrl_mean", "trt_mean", "n_ctrl", "n_trt",
                    relative_lift(F.col("ctrl_mean"), F.col("trt_mean")).alias("lift"),
                    t.alias(f"{unit}_t"))


def naive_pooled_lift(df: DataFrame, value: str = "wait_time_min", arm: str = "assignment",
                      control: str = CONTROL, treatment: str = TREATMENT) -> DataFrame:
    """Q19: every interval treated as independent (biased; for contrast)."""
    return _two_arm(df, value, arm, control, treatment, "naive")


def apply_washout(df: DataFrame, washout_minutes: int = 15, minute: str = "minutes_into_block") -> DataFrame:
    """Drop the first ``washout_minutes`` of every block."""
    return df.where(F.col(minute) >= washout_minutes)


def washout_summary(df: DataFrame, washout_minutes: int = 15,
                    minute: str = "minutes_into_block") -> DataFrame:
    """Q20: one row ``(n, kept, dropped, dropped_share)``."""
    dropped = F.count(F.when(F.col(minute) < washout_minutes, F.lit(1)))
    n = F.count(F.lit(1))
    return df.agg(n.alias("n"), (n - dropped).alias("kept"), dropped.alias("dropped"),
                  safe_div(dropped, n).alias("dropped_share"))


def interval_preagg(df: DataFrame, interval_minutes: int = 5, zone: str = "zone",
                    block: str = "block_id", arm: str = "assignment",
                    minute: str = "minutes_into_block", value: str = "wait_time_min") -> DataFrame:
    """Q21: raw log -> one row per (zone, block, interval) with the mean value
    and event count (partial aggregation before the shuffle)."""
    start = (F.floor(F.col(minute) / interval_minutes) * interval_minutes).cast("long")
    return (df.groupBy(F.col(zone).alias("zone"), F.col(block).alias("block_id"),
                       F.col(arm).alias("assignment"), start.alias("minutes_into_block"))
            .agg(F.avg(value).alias("wait_time_min"), F.count(F.lit(1)).alias("n_events")))


def interval_preagg_by_time(df: DataFrame, ts: str = "ts", interval: str = "5 minutes",
                            keys=("zone", "assignment"), value: str = "wait_time_min") -> DataFrame:
    """Q21 on event time: tumbling ``window(ts, interval)`` per key."""
    return (df.groupBy(*keys, F.window(ts, interval).alias("w"))
            .agg(F.avg(value).alias("wait_time_min"), F.count(F.lit(1)).alias("n_events"))
            .select(*keys, F.col("w.start").alias("interval_start"), "wait_time_min", "n_events"))


def block_means(df_washed: DataFrame, zone: str = "zone", block: str = "block_id",
                arm: str = "assignment", value: str = "wait_time_min") -> DataFrame:
    """Cluster-level collapse: mean per (zone, block, assignment)."""
    return (df_washed.groupBy(F.col(zone).alias("zone"), F.col(block).alias("block_id"),
                              F.col(arm).alias("assignment"))
            .agg(F.avg(value).alias("block_mean")))


def block_level_lift(df_washed: DataFrame, control: str = CONTROL, treatment: str = TREATMENT,
                     **cols) -> DataFrame:
    """Q22: lift and t from block means (blocks are the independent units)."""
    b = block_means(df_washed, **cols)
    return _two_arm(b, "block_mean", "assignment", control, treatment, "block").select(
        "ctrl_mean", "trt_mean", F.col("n_ctrl").alias("n_ctrl_blocks"),
        F.col("n_trt").alias("n_trt_blocks"), "lift", "block_t")


def zone_level_lift(df_washed: DataFrame, control: str = CONTROL, treatment: str = TREATMENT,
                    digits: int = 2, **cols) -> DataFrame:
    """Q23: per-zone block counts, mean outcome per arm and lift, by lift."""
    b = block_means(df_washed, **cols)
    c = F.when(F.col("assignment") == control, F.col("block_mean"))
    t = F.when(F.col("assignment") == treatment, F.col("block_mean"))
    is_c, is_t = F.col("assignment") == control, F.col("assignment") == treatment
    z = b.groupBy("zone").agg(F.count(F.when(is_c, F.lit(1))).alias("control_blocks"),
                              F.count(F.when(is_t, F.lit(1))).alias("treatment_blocks"),
                              F.avg(c).alias("_c"), F.avg(t).alias("_t"))
    return z.select("zone", "control_blocks", "treatment_blocks",
                    F.round("_c", digits).alias("avg_wait_control"),
                    F.round("_t", digits).alias("avg_wait_treatment"),
                    relative_lift(F.col("_c"), F.col("_t")).alias("lift")).orderBy("lift")


def block_transitions(df: DataFrame, head_minutes: int = 10, tail_minutes: int = 10,
                      block_minutes: int = 60, zone: str = "zone", block: str = "block_id",
                      arm: str = "assignment", minute: str = "minutes_into_block",
                      value: str = "wait_time_min") -> DataFrame:
    """One row per block with its first-row assignment, head and tail means,
    and the previous block (next lower block id present in the zone)."""
    m = F.col(minute)
    head, tail = F.when(m < head_minutes, F.col(value)), F.when(m >= block_minutes - tail_minutes, F.col(value))
    # two levels: raw rows are reduced to one per (block, arm) by plain sums,
    # which hash; the first arm (ties: the smaller name) is picked among these
    arms = df.groupBy(F.col(zone).alias("zone"), F.col(block).alias("block_id"), F.col(arm).alias("_arm")).agg(
        F.min(m).alias("_first"), F.sum(head).alias("_hs"), F.count(head).alias("_hn"),
        F.sum(tail).alias("_ts"), F.count(tail).alias("_tn"))
    blocks = arms.groupBy("zone", "block_id").agg(
        F.min(F.struct("_first", "_arm"))["_arm"].alias("assignment"),
        safe_div(F.sum("_hs"), F.sum("_hn")).alias("head_mean"),
        safe_div(F.sum("_ts"), F.sum("_tn")).alias("tail_mean"))
    w = Window.partitionBy("zone").orderBy("block_id")
    return blocks.select(
        "zone", "block_id", "assignment", "head_mean", "tail_mean",
        F.lag("assignment").over(w).alias("prev_assignment"),
        F.lag("tail_mean").over(w).alias("prev_tail_mean"))


def carryover_diagnostic(df: DataFrame, head_minutes: int = 10, tail_minutes: int = 10,
                         block_minutes: int = 60, digits: int = 2, **cols) -> DataFrame:
    """Q24: per transition type ``(transition, n_transitions,
    prev_block_last_10min, new_block_first_10min, gap)``; a type with no
    transitions gives n = 0 and NULL means."""
    bt = block_transitions(df, head_minutes, tail_minutes, block_minutes, **cols)
    bt = bt.where(F.col("prev_assignment").isNotNull() & (F.col("prev_assignment") != F.col("assignment")))
    key = F.concat(F.col("prev_assignment"), F.lit(" -> "), F.col("assignment"))
    aggs, rows = [], []
    for i, tr in enumerate(TRANSITIONS):
        on = key == tr
        aggs += [F.count(F.when(on, F.lit(1))).alias(f"n{i}"),
                 F.avg(F.when(on, F.col("prev_tail_mean"))).alias(f"p{i}"),
                 F.avg(F.when(on, F.col("head_mean"))).alias(f"h{i}")]
        rows.append(F.struct(F.lit(tr).alias("transition"), F.col(f"n{i}").alias("n_transitions"),
                             F.round(F.col(f"p{i}"), digits).alias("prev_block_last_10min"),
                             F.round(F.col(f"h{i}"), digits).alias("new_block_first_10min"),
                             F.round(F.col(f"h{i}") - F.col(f"p{i}"), digits).alias("gap")))
    return bt.agg(*aggs).select(F.inline(F.array(*rows)))


def carryover_curve(df: DataFrame, interval_minutes: int = 5, zone: str = "zone", block: str = "block_id",
                    arm: str = "assignment", minute: str = "minutes_into_block",
                    value: str = "wait_time_min") -> DataFrame:
    """Q25: mean outcome by minute-into-block over the blocks that follow a
    switch, per transition type (the data behind the carry-over chart)."""
    cols = dict(zone=zone, block=block, arm=arm, minute=minute, value=value)
    bt = block_transitions(df, **cols)
    starts = (bt.where(F.col("prev_assignment").isNotNull()
                       & (F.col("prev_assignment") != F.col("assignment")))
              .select("zone", "block_id",
                      F.concat(F.col("prev_assignment"), F.lit(" -> "), F.col("assignment")).alias("transition")))
    curve = interval_preagg(df, interval_minutes, **cols)
    return (curve.join(starts, ["zone", "block_id"])
            .groupBy("transition", "minutes_into_block")
            .agg(F.avg("wait_time_min").alias("avg_wait"), F.count(F.lit(1)).alias("n_blocks")))
