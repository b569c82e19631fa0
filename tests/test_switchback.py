import pytest
from pyspark.sql import functions as F

from helpers import one
from meridian.operators import switchback as sb


@pytest.fixture(scope="module")
def panel(spark):
    """6 zones x 336 blocks x 12 five-minute intervals, closed form: the arm
    alternates by (zone + block // 2); treatment lowers waits by 8%; the
    first 15 minutes after a switch blend linearly from the old arm."""
    rows = []
    for z in range(6):
        base = 6.0 + z
        for b in range(336):
            arm = "Treatment" if (z + b // 2) % 2 else "Control"
            prev = "Treatment" if (z + (b - 1) // 2) % 2 else "Control"
            for m in range(0, 60, 5):
                level = base * (0.92 if arm == "Treatment" else 1.0)
                if b > 0 and prev != arm and m < 15:
                    old = base * (0.92 if prev == "Treatment" else 1.0)
                    w = m / 15.0
                    level = old * (1 - w) + level * w
                rows.append((f"Z{z}", b, arm, m, level + (b % 7) * 0.01))
    return spark.createDataFrame(rows, "zone string, block_id long, assignment string, "
                                       "minutes_into_block long, wait_time_min double")


def test_washout_share(panel):
    r = one(sb.washout_summary(panel, 15))
    assert (r.n, r.dropped, r.dropped_share) == (24192, 6048, 0.25)


def test_block_lift_matches_pandas(panel):
    pdf = panel.toPandas()
    washed = pdf[pdf.minutes_into_block >= 15]
    blocks = washed.groupby(["zone", "block_id", "assignment"]).wait_time_min.mean().reset_index()
    c = blocks[blocks.assignment == "Control"].wait_time_min
    t = blocks[blocks.assignment == "Treatment"].wait_time_min
    lift = (t.mean() - c.mean()) / c.mean()
    bt = (t.mean() - c.mean()) / (c.var() / len(c) + t.var() / len(t)) ** 0.5
    r = one(sb.block_level_lift(sb.apply_washout(panel, 15)))
    assert r.lift == pytest.approx(lift) and r.block_t == pytest.approx(bt)
    assert (r.n_ctrl_blocks, r.n_trt_blocks) == (len(c), len(t))


def test_naive_matches_pandas(panel):
    pdf = panel.toPandas()
    c = pdf[pdf.assignment == "Control"].wait_time_min
    t = pdf[pdf.assignment == "Treatment"].wait_time_min
    r = one(sb.naive_pooled_lift(panel))
    assert r.naive_t == pytest.approx((t.mean() - c.mean()) / (c.var() / len(c) + t.var() / len(t)) ** 0.5)


def test_zone_lift_sorted(panel):
    rows = sb.zone_level_lift(sb.apply_washout(panel, 15)).collect()
    assert len(rows) == 6 and [r.lift for r in rows] == sorted(r.lift for r in rows)


def test_carryover(panel):
    rows = {r.transition: r for r in sb.carryover_diagnostic(panel).collect()}
    ct, tc = rows["Control -> Treatment"], rows["Treatment -> Control"]
    # every second block switches arm: 167 or 168 switches per zone
    assert ct.n_transitions + tc.n_transitions == sum(
        1 for z in range(6) for b in range(1, 336) if (z + b // 2) % 2 != (z + (b - 1) // 2) % 2)
    assert ct.gap < 0 < tc.gap


def test_no_transitions(spark):
    df = spark.createDataFrame([("Z", b, "Control", m, 1.0) for b in range(3) for m in (0, 55)],
                               "zone string, block_id long, assignment string, minutes_into_block long, wait_time_min double")
    rows = sb.carryover_diagnostic(df).collect()
    assert [(r.n_transitions, r.gap) for r in rows] == [(0, None), (0, None)]


def test_curve_and_preagg(panel):
    curve = sb.carryover_curve(panel).where(F.col("transition") == "Control -> Treatment")
    pts = {r.minutes_into_block: r.avg_wait for r in curve.collect()}
    assert sorted(pts) == list(range(0, 60, 5)) and pts[0] > pts[55]
    assert sb.interval_preagg(panel).count() == 24192
