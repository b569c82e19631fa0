"""Types found in text against the explicit schemas, and rows that don't fit."""
import os

import pytest
from helpers import FIX, one
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.sources import infer, schemas
from meridian.sources.io import read_csv

FILES = {"crm": "crm_data.csv", "online": "online_order_data.csv", "pos": "instore_pos_data.csv",
         "cuped": "cuped_streaming_sessions.csv", "rule_customers": "rule_based_customers.csv",
         "rfm_customers": "rfm_customers.csv", "kmeans_customers": "kmeans_customers.csv",
         "cac_spend": "marketing_spend_acquisitions.csv", "host_ramp": "host_ramp_productivity.csv",
         "rdd": "rdd_loyalty_customers.csv"}
# what text can't tell: digits that name a customer, and money in decimals
KNOWN = {"*_id": "string", "*_gbp": "decimal(12,2)"}


@pytest.mark.parametrize("name", FILES)
def test_types_equal_the_explicit_schema(spark, name):
    path = os.path.join(FIX, FILES[name])
    got = infer.read_csv_inferred(spark, path, known=KNOWN)
    want = read_csv(spark, path, name)
    assert got.rows.dtypes == want.dtypes
    assert sorted(map(str, got.rows.collect())) == sorted(map(str, want.collect()))
    assert got.rejects.count() == 0


def _text(spark, rows, names):
    return spark.createDataFrame(rows, T.StructType([T.StructField(n, T.StringType()) for n in names]))


def test_lattice(spark):
    raw = _text(spark, [("1", "1", "2024-01-01", "2024-01-01", "+447", "true", None, "007", "1e3", "x", "9" * 18, "1-2"),
                        ("-2", "2.5", "2024-02-29", "2024-01-01 10:00:01.5", "07", "FALSE", " ", "12", ".5", "", "9" * 30, "")],
                list("abcdefghijkl"))
    types = infer.choose_types(infer.column_profile(raw))
    assert types == dict(zip("abcdefghijkl", ["long", "double", "date", "timestamp", "string", "boolean", "string", "string",
                                              "double", "string", "double", "string"]))


def test_impossible_dates_are_text_or_rejected(spark):
    raw = _text(spark, [("2024-02-30",), *[("2024-02-01",)] * 9], ["d"])
    profile = infer.column_profile(raw)
    assert one(profile).n_date == 9
    assert infer.choose_types(profile) == {"d": "string"}
    types = infer.choose_types(profile, max_reject_share=0.1)
    assert types == {"d": "date"}
    got = infer.typed_with_rejects(raw, types)
    assert (got.rows.count(), got.rejects.count()) == (9, 1)


def test_a_wider_type_comes_before_rejects(spark):
    raw = _text(spark, [("1",)] * 99 + [("1.5",)], ["v"])
    assert infer.choose_types(infer.column_profile(raw), max_reject_share=0.1) == {"v": "double"}


def test_every_row_is_kept_or_rejected(spark):
    raw = _text(spark, [("1", "a"), ("x", "b"), (None, "c"), ("", None), ("x", "b")], ["n", "t"])
    got = infer.typed_with_rejects(raw, {"n": "long", "t": "string"})
    assert sorted(got.rows.collect(), key=str) == [(1, "a"), (None, "c"), (None, None)]
    assert [r["_rejected"] for r in got.rejects.collect()] == [["n"], ["n"]]
    assert one(infer.reject_counts(got)) == ("n", 2)
    none = infer.typed_with_rejects(raw, {"n": "string", "t": "string"})
    assert (none.rows.count(), none.rejects.count()) == (5, 0)


def test_lines_with_too_few_or_many_cells(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c d\n1,2,3\n4,5\n6,7,8,9\n10,11,12\n")
    got = infer.read_csv_inferred(spark, str(tmp_path / "x.csv"))
    assert got.types["a"] == "long" and got.types["c d"] == "long"
    assert sorted(got.rows.collect()) == [(1, 2, 3), (10, 11, 12)]
    assert [r["_rejected"] for r in got.rejects.collect()] == [[infer.MALFORMED]] * 2


def test_empty_table(spark):
    raw = _text(spark, [], ["a", "b"])
    assert infer.choose_types(infer.column_profile(raw)) == {"a": "string", "b": "string"}
    assert infer.typed_with_rejects(raw, {"a": "long", "b": "string"}).rows.count() == 0


def test_one_pass(spark):
    raw = spark.range(100).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    plan = infer.column_profile(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "Join" not in plan


def test_explicit_schemas_stay(spark):
    assert set(FILES) <= set(schemas.BY_NAME)
