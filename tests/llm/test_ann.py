"""Nearest neighbours against brute force: exact scores and order, recall, odd inputs."""
import numpy as np
import pytest

from meridian.llm import ann as A

COLS = ["query_id", "rank", "vec_id", "score"]


def brute(ids, x, k=20, every=20):
    """For each query id the (score, id) of its k nearest."""
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            scores = np.zeros(len(x))
            for d in range(x.shape[1]):
                scores += q[d] * x[:, d]
            out[i] = sorted(((-s, j) for s, j in zip(scores, ids) if j != i))[:k]
    return out


def table(spark, ids, x):
    return spark.createDataFrame([(int(i), v if v is None else [None if c is None else float(c) for c in v]) for i, v in zip(ids, x)],
                                 "vec_id long, embedding array<float>").selectExpr("*", "1 as list", "'x' as score")


def run(spark, ids, x, k=20, every=20, **kw):
    df = table(spark, ids, x)
    got = A.nearest(df, df.where(df.vec_id % every == 0), k, lists=A.LISTS, **kw)
    assert got.columns == COLS
    out = {}
    for r in sorted(got.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    return sum(len({j for _, j in got.get(i, [])} & {j for _, j in best}) for i, best in want.items()) \
        / sum(len(best) for best in want.values())


def made(seed, n=3000, d=40, clusters=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    if clusters:
        x = x * .3 + rng.standard_normal((clusters, d))[rng.integers(0, clusters, n)]
    return np.arange(n), (x * rng.lognormal(0, .3, (n, 1))).astype(np.float32).astype(np.float64)


@pytest.mark.parametrize("clusters", [0, 12])
def test_recall_and_exact_scores(spark, monkeypatch, clusters):
    """Blocks of 100 vectors, parts of 40 queries, steps of 64: the split changes nothing."""
    for name, value in {"BLOCK": 60, "PART": 80, "STEP": 32, "SAMPLE": 1500}.items():
        monkeypatch.setattr(A, name, value)
    ids, x = made(7, clusters=clusters)
    want, got = brute(ids, x), run(spark, ids, x)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    for i, found in got.items():
        assert found == sorted(found)
        for s, j in found:
            total = 0.0
            for a, b in zip(x[i], x[j]):
                total += a * b
            assert -s == total
    assert recall(got, want) >= 0.95


def test_all_lists_and_no_test_is_exact(spark):
    ids, x = made(3, 700, 19)
    assert run(spark, ids, x, target=1.1, error=1e9) == brute(ids, x)


def test_adaptive_scan_gives_up_most_candidates(monkeypatch):
    """The tests do the work: few candidates get to the last block."""
    ids, x = made(5, 4000, 128)
    model = A.Model(128, float(np.abs(x).max()), float(((x / np.abs(x).max()) ** 2).sum(1).max()), np.zeros((1, 129)),
                    np.linalg.qr(np.random.default_rng(0).standard_normal((128, 128)))[0], 1)
    seen = []
    monkeypatch.setattr(A, "STEP", 200)                # the first step has no bound yet
    exact = A._exact
    monkeypatch.setattr(A, "_exact", lambda q, c: seen.append(len(q)) or exact(q, c))
    found = A.scan(x, ids, x[:50], ids[:50], np.full(50, -np.inf), model, 20)
    want = brute(ids, x, every=1)
    hits = sum(len({j for _, j in want[i]} & set(found[i][1])) for i in range(50))
    assert hits >= 0.95 * 50 * 20 and sum(seen) < 0.1 * 50 * 4000


def test_ties_repeated_rows_and_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK", 50)
    monkeypatch.setattr(A, "LISTS", 8)
    ids, x = made(9, 400, 8)
    x[100:250] = x[100]                               # a third of all rows are one vector
    want = brute(ids, x)
    got = run(spark, np.r_[ids, ids[:120]], np.r_[x, x[:120]], target=1.1, error=1e9)   # repeated rows
    assert got == want and any([j for _, j in v][:3] == [101, 102, 103] for v in got.values())


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0]]
    assert run(spark, range(6), bad) == {} and run(spark, [], []) == {}
    got = run(spark, [20, 1, 2, 3, 40, 5, 6, 7, 60, 9], bad + [[1.0, 2.0], [3.0], [2.0, 0.0], [-1.0, 4.0, 1.0]])
    # a shorter vector is filled up; those of the bad rows neither ask nor are found
    assert got == {60: [(-6.0, 7), (-2.0, 6), (2.0, 9)]}
    assert run(spark, [20], [[1.0, 2.0]]) == {}
    df = spark.createDataFrame([(None, [1.0, 1.0]), (20, [1.0, 0.0]), (3, [1e300, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in A.nearest(df, df).collect()) == [(3, 1, 20, 1e300), (20, 1, 3, 1e300)]


def test_recall_on_the_given_vectors(spark):
    from meridian.llm.common import load
    from llm_helpers import SF
    rows = load(spark, SF.replace("0.001", "0.1"), "embeddings").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    want, got = brute(ids, x), run(spark, ids, x)
    assert recall(got, want) >= 0.95
