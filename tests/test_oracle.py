"""Every registered query against its DuckDB oracle on the smallest driver
tables (the driver's own check runs the same comparison at sf0.01)."""
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


def test_all_queries_match_oracle(spark):
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from check_oracle import compare
    from meridian.plans.catalog import QUERIES
    res = compare(spark, SF, list(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if v != "OK" and not v.startswith("rows-only")}
    assert not bad, bad


def test_every_query_but_nonsql_has_oracle():
    from meridian.plans.catalog import QUERIES
    from meridian.plans.oracle import ORACLE
    assert set(QUERIES) - set(ORACLE) == {"segment_kmeans", "segment_kmeans_counts"}


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "omni_lookup_id" in df.columns
