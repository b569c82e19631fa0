"""Plan hygiene for every registered query, planned as if every table were
large (automatic broadcast off): no cartesian product, no nested-loop join,
no row-at-a-time Python UDF, and Parquet scans read only needed columns."""
import os
import re

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def test_no_forbidden_operators(spark):
    from meridian.plans.catalog import QUERIES
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bad = {}
        for name, fn in QUERIES.items():
            if name.startswith("segment_kmeans"):
                continue
            plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
            hits = [op for op in FORBIDDEN if op in plan]
            # lineitem has 11 columns; no query needs more than 3 of them
            for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
                if "l_orderkey" in schema and schema.count(":") > 3:
                    hits.append("wide lineitem scan")
            if hits:
                bad[name] = hits
        assert not bad, bad
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["rdd_estimate", "rdd_density_check", "rdd_placebo", "rdd_bandwidth_sensitivity"])
def test_rdd_windows_reach_the_scan(spark, name):
    from meridian.plans.catalog import QUERIES
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if "c_acctbal" in p]
    assert pushed and "GreaterThanOrEqual(c_acctbal" in pushed[0] and "LessThan" in pushed[0], plan


@pytest.mark.parametrize("name", ["carryover_diagnostic", "carryover_curve"])
def test_carryover_sorts_no_raw_events(spark, name):
    from meridian.plans.catalog import QUERIES
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    # a sort-based aggregate may only stand above the per-block rows, never on the scan's own rows
    for i, line in enumerate(lines):
        if "SortAggregate" in line and "partial" in line:
            below = "\n".join(lines[i + 1:i + 6])
            assert "FileScan" not in below, plan
