"""Stored results: one resolution per session and input, lists and their split."""
import os
import shutil

import pytest
from pyspark.sql import functions as F

from helpers import FIX, one
from meridian.functions.tables import register_tables_functions
from meridian.operators import identity as idn
from meridian.sources.io import read_csv
from meridian.sources.store import Store, fingerprint

FILES = {"crm": "crm_data.csv", "online": "online_order_data.csv", "pos": "instore_pos_data.csv"}


@pytest.fixture
def channels(spark, tmp_path):
    """The three channels in a folder of their own: channels() reads them."""
    for f in FILES.values():
        shutil.copy(os.path.join(FIX, f), tmp_path / f)
    return lambda: [read_csv(spark, str(tmp_path / f), k) for k, f in FILES.items()], tmp_path


@pytest.fixture
def rounds(monkeypatch):
    """How often the graph was worked out."""
    calls, real = [], idn.connected_components
    monkeypatch.setattr(idn, "connected_components", lambda *a, **k: calls.append(1) or real(*a, **k))
    return calls


def rows(df):
    return sorted(map(str, df.collect()))


def test_second_query_reads_what_the_first_stored(channels, rounds):
    read, _ = channels
    first, second = idn.Views(*read()), idn.Views(*read())
    a = first.customers
    assert len(rounds) == 1 and "ids" in first.store.built
    b = second.customers
    assert len(rounds) == 1 and second.store.built == []
    assert rows(a) == rows(b) and a.count() == 16
    assert rows(idn.Views(*read()).ids) == rows(first.ids) and len(rounds) == 1


def test_changed_input_is_resolved_anew(channels, rounds):
    read, folder = channels
    assert idn.Views(*read()).ids.count() == 34
    with open(folder / FILES["crm"], "a") as f:
        f.write("L99999,New,Person,new@x.com,07000000001,1 Road,Town,AB1 2CD,UK,1990-01-01,web,2024-01-01,Yes,No\n")
    again = idn.Views(*read())
    assert again.ids.count() == 35 and len(rounds) == 2
    assert again.customers.count() == 17


def test_another_projection_and_plain_rows_are_told_apart(spark, channels):
    crm, _, _ = channels[0]()
    assert fingerprint(crm) == fingerprint(channels[0]()[0])
    assert fingerprint(crm) != fingerprint(crm.where(F.col("loyalty_id") > "L10003"))
    assert fingerprint(crm) != fingerprint(crm, salt="x")
    assert fingerprint(spark.range(3)) is None
    assert fingerprint(crm.join(spark.createDataFrame([("L1",)], "loyalty_id string"), "loyalty_id")) is None
    # rows that can't be recognised are stored for one object only
    a, b = (Store(spark.range(n)) for n in (3, 4))
    assert a.table("t", lambda: spark.range(3)).count() == 3 and b.table("t", lambda: spark.range(4)).count() == 4


def test_a_lost_driver_leaves_nothing_half_written(channels, tmp_path):
    crm, _, _ = channels[0]()
    store = Store(crm, root=str(tmp_path / "kept"))

    def fails():
        raise ValueError("lost")
    with pytest.raises(ValueError):
        store.table("t", fails)
    assert store.table("t", lambda: crm.select("loyalty_id")).count() == 11
    # another session with the same root reads it
    other = Store(channels[0]()[0], root=str(tmp_path / "kept"))
    assert other.table("t", fails).count() == 11 and other.built == []


def test_lists_equal_the_reference_string_and_split_back(channels):
    v = idn.Views(*channels[0]())
    oc = one(v.customers.where(F.col("last_name") == "O'Connor"))
    assert oc.matched_source_record_ids == "CRM-L10004; ONLINE-7451200812; POS-T20003; POS-T20004"
    assert rows(idn.split_lists(v.lists)) == rows(v.ids.select("omni_lookup_id", "record_id"))
    assert rows(idn.id_crosswalk(idn.split_lists(v.lists), v.customers)) == rows(idn.id_crosswalk(v.ids, v.customers))
    check = one(idn.list_check(v.lists, v.ids))
    assert (check.customers, check["items"], check.customers_with_other_count, check.unknown_items) == (16, 34, 0, 0)
    # a damaged list is noticed
    worse = v.lists.withColumn("record_ids", F.replace("record_ids", F.lit("POS-T20003"), F.lit("POS-T2")))
    assert one(idn.list_check(worse, v.ids)).unknown_items == 1
    short = v.lists.withColumn("record_ids", F.replace("record_ids", F.lit("; POS-T20003"), F.lit("")))
    assert one(idn.list_check(short, v.ids)).customers_with_other_count == 1


def test_giant_customer_is_listed_in_chunks(spark):
    """A third of all records are one customer's: chunks of ten, in order,
    gathered ten records at a time, hot keys split."""
    ids = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 'OID-00001', concat('OID-', lpad(cast(id as string), 7, '0'))) as omni_lookup_id",
        "concat('POS-', lpad(cast((id * 7919) % 30000 as string), 6, '0')) as record_id")
    lists = idn.record_lists(ids, num_partitions=13, hot_rows=500).persist()
    assert lists.count() == 1_000 + 20_000 and lists.agg(F.max("n_records")).first()[0] == 10
    giant = [r.record_ids for r in lists.where("omni_lookup_id = 'OID-00001'").orderBy("chunk_no").collect()]
    want = sorted(r[0] for r in ids.where("omni_lookup_id = 'OID-00001'").select("record_id").collect())
    assert "; ".join(giant).split("; ") == want
    assert one(idn.list_check(lists, ids)).customers_with_other_count == 0
    joined = one(idn.joined_lists(lists).where("omni_lookup_id = 'OID-00001'"))
    assert joined.matched_source_record_ids.split("; ") == want[:idn.LISTED_RECORDS]
    lists.unpersist()


def test_lists_of_no_records(spark):
    none = spark.createDataFrame([], "record_id string, omni_lookup_id string")
    lists = idn.record_lists(none)
    assert lists.count() == 0 and idn.split_lists(lists).count() == 0


def test_table_function_splits_stored_lists(spark, channels):
    register_tables_functions(spark)
    got = [tuple(r) for r in spark.sql("SELECT * FROM split_list(' a; b ;;c.d; ', ';')").collect()]
    assert got == [(0, "a"), (1, "b"), (3, "c.d")]
    assert spark.sql("SELECT * FROM split_list(NULL, ';')").count() == 0
    v = idn.Views(*channels[0]())
    v.customers.createOrReplaceTempView("stored_customer_360")
    got = spark.sql("""SELECT c.omni_lookup_id, s.item AS record_id
        FROM stored_customer_360 c, LATERAL split_list(c.matched_source_record_ids, ';') s""")
    assert rows(got) == rows(idn.split_lists(v.lists))
