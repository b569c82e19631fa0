import pytest

from helpers import one
from meridian.operators import cohort

COHORTS = ["2026-01", "2026-02", "2026-03", "2026-04", "2026-05", "2026-06"]
CHURNED_M1 = [60, 55, 108, 136, 169, 205]


@pytest.fixture(scope="module")
def events(spark):
    # 1000 hosts per cohort; the first k churn at month 1, a further 5% at month 3
    rows = []
    for c, k in zip(COHORTS, CHURNED_M1):
        for i in range(1000):
            off = 1.0 if i < k else (3.0 if i < k + 50 else None)
            rows.append((f"{c}-{i}", c, off))
    return spark.createDataFrame(rows, "host_id string, signup_month string, churned_month_offset double")


def test_month1_rates(events):
    rows = cohort.retention_at_tenure(events, as_of="2026-07", tenure=1).orderBy("cohort").collect()
    assert [r.pct for r in rows] == [94.0, 94.5, 89.2, 86.4, 83.1, 79.5]
    assert rows[0].decline_first_to_last == 14.5


def test_matrix_triangle(events):
    rows = {r.cohort: r for r in cohort.retention_matrix(events, as_of="2026-07", max_tenure=6).collect()}
    assert rows["2026-06"].m1 == 79.5 and rows["2026-06"].m2 is None
    assert rows["2026-01"].m6 == 89.0 and rows["2026-01"].m0 == 100.0


def test_vintage_decline(events):
    r = one(cohort.vintage_decline(events, as_of="2026-07"))
    assert (r.confirmed, r.started_at, r.streak) == (True, "2026-02", 3)


def test_vintage_decline_none(spark):
    ev = spark.createDataFrame([(f"{c}-{i}", c, None) for c in COHORTS for i in range(10)],
                               "host_id string, signup_month string, churned_month_offset double")
    r = one(cohort.vintage_decline(ev, as_of="2026-07"))
    assert (r.confirmed, r.started_at, r.streak) == (False, None, None)


def test_blended_rate(events):
    rows = {r.calendar_month: r for r in cohort.blended_active_rate(events, first_cohort="2026-01",
                                                                     as_of="2026-07").collect()}
    assert rows["2026-01"].pct == 100.0 and rows["2026-01"].total == 1000
    assert rows["2026-07"].total == 6000
    # brute force for 2026-07: each cohort j at tenure 6 - j
    active = sum(1000 - k - (50 if (6 - j) >= 3 else 0) for j, k in enumerate(CHURNED_M1))
    assert rows["2026-07"].active == active


def test_mix_shift(events):
    r = one(cohort.mix_shift_projection(events, as_of="2026-07", recovered_rate=96, new_cohort_size=800))
    before = sum([94.0, 94.5, 89.2, 86.4, 83.1, 79.5]) / 6
    assert r.before == pytest.approx(before)
    assert r.after == pytest.approx((before * 6000 + 96 * 800) / 6800)


def test_lenient_offset(spark, tmp_path):
    from meridian.sources.io import read_cohort_events
    p = tmp_path / "ev.csv"
    p.write_text("host_id,signup_month,churned_month_offset\nh1,2026-01,2\nh2,2026-01,n/a\nh3,2026-01,\n")
    df = read_cohort_events(spark, str(p))
    assert [r.churned_month_offset for r in df.orderBy("host_id").collect()] == [2.0, None, None]
