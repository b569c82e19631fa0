"""Randomised comparisons of Spark operators with straightforward Python
implementations of the same definitions (a few seeded datasets each)."""
import random

import pytest

from meridian.operators import cohort, rdd

SEEDS = [1, 2, 3]


@pytest.mark.parametrize("seed", SEEDS)
def test_rdd_estimate_and_density(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randint(8800, 11200), rnd.choice([None, round(rnd.uniform(0, 500), 2)])) for _ in range(400)]
    df = spark.createDataFrame(rows, "points_score long, annual_spend double")
    for c, b in [(10000, 500), (9500, 250)]:
        win = [(x, y) for x, y in rows if c - b <= x < c + b]
        below = [y for x, y in win if x < c]
        above = [y for x, y in win if x >= c]
        mean = lambda v: (sum(t for t in v if t is not None) / len([t for t in v if t is not None])
                          if any(t is not None for t in v) else None)
        r = rdd.discontinuity_estimate(df, bandwidth=b, cutoff=c).collect()[0]
        assert (r.n_below, r.n_above) == (len(below), len(above))
        assert r.below_mean == pytest.approx(mean(below)) and r.above_mean == pytest.approx(mean(above))
    edges = list(range(10000 - 800, 10000 + 801, 200))
    counts = [0] * 8
    for x, _ in rows:
        for i in range(8):
            if edges[i] <= x < edges[i + 1] or (i == 7 and x == edges[8]):
                counts[i] += 1
                break
    got = [r["count"] for r in rdd.density_check(df).orderBy("bin_index").collect()]
    assert got == counts


def _retention_brute(members, cohorts, as_of_idx, tenure):
    out = {}
    for j, c in enumerate(cohorts):
        if tenure > as_of_idx - j:
            continue
        sub = [o for cc, o in members if cc == c]
        if not sub:
            continue
        active = sum(1 for o in sub if not (o is not None and o <= tenure))
        # half-up rounding of 100 * active / n to one decimal, on integers
        out[c] = ((2000 * active + len(sub)) // (2 * len(sub))) / 10
    return out


@pytest.mark.parametrize("seed", SEEDS)
def test_retention_and_decline(spark, seed):
    rnd = random.Random(seed)
    cohorts = [f"2026-{m:02d}" for m in range(1, 7)]
    members = [(rnd.choice(cohorts), rnd.choice([None, None, 0.0, 1.0, 2.0, 3.0, 5.0])) for _ in range(600)]
    df = spark.createDataFrame([(f"h{i}", c, o) for i, (c, o) in enumerate(members)],
                               "host_id string, signup_month string, churned_month_offset double")
    m = {r.cohort: r for r in cohort.retention_matrix(df, as_of="2026-07", max_tenure=6).collect()}
    for t in range(7):
        exp = _retention_brute(members, cohorts, 6, t)
        got = {c: getattr(m[c], f"m{t}") for c in cohorts if getattr(m[c], f"m{t}") is not None}
        assert got == exp, t
    # vintage decline on the month-1 series, by the streak definition
    series = sorted(_retention_brute(members, cohorts, 6, 1).items())
    streak, start, found = 1, None, None
    for i in range(1, len(series)):
        if series[i][1] < series[i - 1][1] - 1.0:
            streak += 1
            start = start or series[i - 1][0]
        else:
            streak, start = 1, None
        if streak >= 3 and start:
            found = (start, streak)
            break
    r = cohort.vintage_decline(df, as_of="2026-07").collect()[0]
    assert ((r.started_at, r.streak) if r.confirmed else None) == found


@pytest.mark.parametrize("seed", SEEDS)
def test_carryover_and_block_lift(spark, seed):
    from meridian.operators import switchback as sb
    rnd = random.Random(seed)
    rows = []
    for z in ("A", "B"):
        blocks = sorted(rnd.sample(range(40), 25))          # gaps: adjacency = next present block
        for b in blocks:
            arm = rnd.choice(["Control", "Treatment"])
            for m in range(0, 60, 5):
                if rnd.random() < 0.8:
                    rows.append((z, b, arm, m, rnd.choice([None, round(rnd.uniform(1, 9), 2)])))
    df = spark.createDataFrame(rows, "zone string, block_id long, assignment string, "
                                     "minutes_into_block long, wait_time_min double")
    # brute force, following the definition block by block
    res = {"Control -> Treatment": [], "Treatment -> Control": []}
    for z in ("A", "B"):
        zr = [r for r in rows if r[0] == z]
        ids = sorted({r[1] for r in zr})
        for prev, cur in zip(ids, ids[1:]):
            pb = sorted((r for r in zr if r[1] == prev), key=lambda r: r[3])
            cb = sorted((r for r in zr if r[1] == cur), key=lambda r: r[3])
            if pb[0][2] == cb[0][2]:
                continue
            tail = [r[4] for r in pb if r[3] >= 50 and r[4] is not None]
            head = [r[4] for r in cb if r[3] < 10 and r[4] is not None]
            res[f"{pb[0][2]} -> {cb[0][2]}"].append((sum(tail) / len(tail) if tail else None,
                                                     sum(head) / len(head) if head else None))
    got = {r.transition: r for r in sb.carryover_diagnostic(df).collect()}
    for k, recs in res.items():
        tails = [t for t, _ in recs if t is not None]
        heads = [h for _, h in recs if h is not None]
        assert got[k].n_transitions == len(recs)
        if tails:
            assert got[k].prev_block_last_10min == pytest.approx(round(sum(tails) / len(tails), 2), abs=0.0051)
        if heads:
            assert got[k].new_block_first_10min == pytest.approx(round(sum(heads) / len(heads), 2), abs=0.0051)
    # block-level lift on washed rows
    washed = [r for r in rows if r[3] >= 15]
    keys = sorted({(r[0], r[1], r[2]) for r in washed})
    means = {}
    for key in keys:
        vals = [r[4] for r in washed if (r[0], r[1], r[2]) == key and r[4] is not None]
        if vals:
            means[key] = sum(vals) / len(vals)
    c = [v for k, v in means.items() if k[2] == "Control"]
    t = [v for k, v in means.items() if k[2] == "Treatment"]
    r = sb.block_level_lift(sb.apply_washout(df, 15)).collect()[0]
    assert r.ctrl_mean == pytest.approx(sum(c) / len(c)) and r.trt_mean == pytest.approx(sum(t) / len(t))


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("compression", [0.5, 0.75, 0.3, 0.4])
def test_ramp_shortfall_and_compression(spark, seed, compression):
    from meridian.operators import cac
    rnd = random.Random(seed)
    rows = [(f"H{h}", m, round(rnd.uniform(0, 60 * m), 2)) for h in range(30) for m in range(1, 7)
            if rnd.random() < 0.9]
    df = spark.createDataFrame(rows, "host_id string, month_since_signup long, monthly_revenue double")
    by_month = {m: [r for _, mm, r in rows if mm == m] for m in range(1, 7)}
    avg = {m: sum(v) / len(v) for m, v in by_month.items() if v}
    steady = sum(avg[m] for m in (4, 5, 6)) / 3
    shortfall = sum(max(steady - avg[m], 0) for m in range(1, 5))
    compressed = sum(max(steady - avg.get(round(min(m / compression, 6)), steady), 0) for m in range(1, 5))
    r = cac.ramp_compression(df, compression=compression).collect()[0]
    assert r.original_shortfall == pytest.approx(shortfall)
    assert r.compressed_shortfall == pytest.approx(compressed)
