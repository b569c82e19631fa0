import random

import pytest
from pyspark.sql import functions as F

from meridian.operators.graph import connected_components


def _cc(spark, nodes, edges):
    n = spark.createDataFrame([(x,) for x in nodes], "node string")
    e = spark.createDataFrame(edges, "a string, b string")
    return {r.node: r.root for r in connected_components(n, e).collect()}


def test_cycle_terminates(spark):
    out = _cc(spark, ["a", "b", "c", "d"], [("a", "b"), ("b", "c"), ("c", "a")])
    assert out == {"a": "a", "b": "a", "c": "a", "d": "d"}


def test_direction_and_order_invariant(spark):
    e1 = [("b", "c"), ("d", "c"), ("e", "f")]
    e2 = [("c", "b"), ("c", "d"), ("f", "e")]
    assert _cc(spark, list("bcdef"), e1) == _cc(spark, list("fedcb"), e2) == \
        {"b": "b", "c": "b", "d": "b", "e": "e", "f": "e"}


def test_long_chain_few_rounds(spark):
    n = 10_000
    ids = spark.range(n).select(F.format_string("N%06d", "id").alias("node"))
    edges = spark.range(n - 1).select(F.format_string("N%06d", "id").alias("a"),
                                      F.format_string("N%06d", F.col("id") + 1).alias("b"))
    out = connected_components(ids, edges, max_rounds=30)
    assert out.select("root").distinct().collect()[0][0] == "N000000"
    assert out.count() == n


def test_hot_hub_uses_split_join(spark):
    # a star of 5,000 leaves with a tiny hot threshold exercises the broadcast path
    n = spark.range(5001).select(F.format_string("S%05d", "id").alias("node"))
    e = spark.range(1, 5001).select(F.lit("S00000").alias("a"), F.format_string("S%05d", "id").alias("b"))
    out = connected_components(n, e, hot_rows=100)
    assert out.where(F.col("root") != "S00000").count() == 0


def _uf(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def test_random_graphs_match_union_find(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    names = [f"n{i:02d}" for i in range(25)]

    @settings(max_examples=8, deadline=None, derandomize=True)
    @given(st.lists(st.tuples(st.sampled_from(names), st.sampled_from(names)), max_size=40),
           st.randoms(use_true_random=False))
    def check(edges, rnd):
        expected = _uf(names, edges)
        shuffled = [(b, a) if rnd.random() < 0.5 else (a, b) for a, b in edges]
        rnd.shuffle(shuffled)
        assert _cc(spark, names, edges) == expected
        assert _cc(spark, list(reversed(names)), shuffled) == expected

    check()


def test_million_record_hot_key_no_pair_blowup(spark):
    """10^6 records, a third sharing one placeholder phone, the rest in
    e-mail pairs: star edges stay linear and components converge within
    the round cap."""
    from meridian.operators import identity as idn
    n = 1_000_000
    rec = spark.range(n).select(
        F.format_string("R%07d", "id").alias("record_id"), F.lit("pos").alias("source_system"),
        F.when(F.col("id") % 3 != 0, F.format_string("e%d", (F.col("id") / 2).cast("long"))).alias("email_norm"),
        F.when(F.col("id") % 3 == 0, F.lit("0000")).alias("phone_norm"),
        F.lit(None).cast("string").alias("loyalty_id_norm"))
    e = idn.star_edges(rec, hot_rows=10_000).checkpoint()
    # 333,333 links to the phone hub + one link per e-mail pair
    n_pairs = sum(1 for k in range(n // 2) if (2 * k) % 3 and (2 * k + 1) % 3)
    assert e.count() == (n // 3) + n_pairs
    comp = idn.components(rec, edges=e, hot_rows=10_000)
    roots = comp.groupBy("component_root").count()
    assert roots.where(F.col("component_root") == "R0000000").collect()[0]["count"] == n // 3 + 1
    assert roots.count() == n - e.count()


# --------------------------------------------------------------------------- contraction within tasks
def _rounds(monkeypatch, run):
    """What ``run`` returns, and how many edge tables were checkpointed for it."""
    from meridian.operators import graph
    seen, real = [], graph.checkpointed
    monkeypatch.setattr(graph, "checkpointed", lambda df: seen.append(1) or real(df))
    return run(), len(seen)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_contraction_gives_the_same_roots(spark, kind):
    r = random.Random(11)
    edges = [(r.randint(0, 400), r.randint(0, 400)) for _ in range(300)] + [(7, 7)] * 3 + [(400, 0)] * 200
    e = spark.createDataFrame([*edges, (None, 5), (5, None)], "a long, b long")
    n = spark.range(401).select(F.col("id").alias("node"))
    if kind == "string":
        e, n = e.select(*[F.format_string("é%03d", c).alias(c) if c else c for c in ("a", "b")]).where("a <> 'énull' and b <> 'énull'"), \
            n.select(F.format_string("é%03d", "node").alias("node"))
    plain = {x.node: x.root for x in connected_components(n, e).collect()}
    got = {x.node: x.root for x in connected_components(n, e.repartition(5), contract=True).collect()}
    assert got == plain and len(got) == 401


def test_local_roots_of_odd_shapes():
    import numpy as np

    from meridian.operators.graph import local_roots
    chain = np.random.default_rng(1).permutation(5_000)
    nodes, roots = local_roots(chain[:-1], chain[1:])
    assert len(nodes) == 5_000 and (roots == 0).all()
    nodes, roots = local_roots(np.full(999, 999), np.arange(999))
    assert (roots == 0).all()
    nodes, roots = local_roots(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert len(nodes) == len(roots) == 0


def test_contraction_of_a_chain_takes_half_the_rounds(spark, monkeypatch):
    n = 600
    e = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).repartition(8, "a")
    nodes = spark.range(n).select(F.col("id").alias("node"))
    plain, many = _rounds(monkeypatch, lambda: connected_components(nodes, e))
    got, few = _rounds(monkeypatch, lambda: connected_components(nodes, e, contract=True))
    assert got.where("root <> 0").isEmpty() and got.count() == n
    assert 2 * few <= many, (few, many)


def test_contraction_in_bounded_runs(spark, monkeypatch):
    from meridian.operators import graph
    monkeypatch.setattr(graph, "LOCAL_EDGES", 3)
    e = spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long")
    assert graph.star_edges_to_labels(e, contract=True).where("root <> 0").isEmpty()
    assert graph.star_edges_to_labels(e.limit(0), contract=True).isEmpty()
