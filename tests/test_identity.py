import pytest
from pyspark.sql import functions as F

from helpers import one
from meridian.operators import identity as idn


@pytest.fixture(scope="module")
def resolved(fx):
    st, ids = idn.resolve(fx("crm"), fx("online"), fx("pos"))
    c360 = idn.customer_360(st, ids).checkpoint(eager=True)
    return st, ids, c360


def test_records_to_customers(resolved):
    st, ids, c360 = resolved
    assert idn.all_records(st).count() == 34
    assert ids.select("omni_lookup_id").distinct().count() == 16
    assert c360.count() == 16
    seg = {r.channel_segment: r["count"] for r in c360.groupBy("channel_segment").count().collect()}
    assert seg == {"Omnichannel": 6, "Online only": 6, "In-store only": 4}


def test_conflicting_contacts_flagged(resolved):
    c360 = resolved[2]
    review = {(r.omni_lookup_id, r.first_name, r.last_name) for r in
              c360.where(F.col("match_confidence").startswith("Review")).collect()}
    assert review == {("OID-00005", "Jane", "Smith"), ("OID-00008", "Ryan", "Cooper")}


def test_return_nets_to_zero_and_audit_rows(resolved):
    st, ids, c360 = resolved
    r = one(c360.where(F.col("last_name") == "O'Connor"))
    assert float(r.total_instore_spent_gbp) == 0.0
    trail = idn.customer_records(ids)
    own = sorted(tuple(x) for x in trail.where(F.col("omni_lookup_id") == r.omni_lookup_id)
                 .select("source_system", "record_id").collect())
    assert own == [("crm", "CRM-L10004"), ("online", "ONLINE-7451200812"), ("pos", "POS-T20003"), ("pos", "POS-T20004")]
    # every record of every customer is there
    assert trail.count() == 34
    n = {x.omni_lookup_id: x["count"] for x in trail.groupBy("omni_lookup_id").count().collect()}
    assert all(n[x.omni_lookup_id] == x.n_source_records for x in c360.collect())


def test_single_source_customers_keep_ids(resolved):
    out = {r.last_name: r.omni_lookup_id for r in resolved[2].where(F.col("last_name").isin("Jenkins", "Ltd")).collect()}
    assert out == {"Jenkins": "OID-00015", "Ltd": "OID-00013"}


def test_crosswalk(resolved):
    st, ids, c360 = resolved
    cw = idn.id_crosswalk(ids, c360)
    oc = cw.where(F.col("omni_lookup_id") == one(c360.where(F.col("last_name") == "O'Connor")).omni_lookup_id)
    rows = sorted((r.loyalty_id, r.online_customer_id, r.pos_transaction_id) for r in oc.collect())
    assert rows == [("L10004", "7451200812", "T20003"), ("L10004", "7451200812", "T20004")]
    # every customer appears; customers without POS have one row with NULL
    assert cw.select("omni_lookup_id").distinct().count() == 16


def test_completeness_invariants(resolved):
    st, ids, c360 = resolved
    r = one(idn.completeness(st, ids, c360))
    assert (r.records_without_id, r.records_with_multiple_ids, r.records_without_customer_row) == (0, 0, 0)
    assert r.all_record_rows == 34 and r.customer_360_rows == 16


def test_star_edges_linear_and_same_components(spark):
    # one phone shared by 200 records: star gives 199 edges, not 19,900 pairs
    rec = spark.createDataFrame([(f"R{i:04d}", "pos", None, "0700", None) for i in range(200)],
                                "record_id string, source_system string, email_norm string, "
                                "phone_norm string, loyalty_id_norm string")
    e = idn.star_edges(rec)
    assert e.count() == 199
    comp = idn.components(rec)
    assert comp.select("component_root").distinct().collect()[0][0] == "R0000"


def test_orphan_return_and_multi_sale(spark):
    crm = spark.createDataFrame([], idn_crm_schema())
    online = spark.createDataFrame([], idn_online_schema())
    pos = spark.createDataFrame([
        ("T1", "S", None, "A", "B", "a@x", None, None, "No", "Sale", 10.0, "R1"),
        ("T2", "S", None, "A", "B", "b@x", None, None, "No", "Sale", 5.0, "R1"),
        ("T3", "S", None, "", "", "", "", "", "No", "Return", -10.0, "R1"),
        ("T4", "S", None, "", "", "", "", "", "No", "Return", -3.0, "R9"),
    ], "transaction_id string, store_location string, transaction_date date, first_name string, "
       "last_name string, email string, phone string, loyalty_id string, staff_discount string, "
       "transaction_type string, amount_gbp double, order_reference string")
    st, ids = idn.resolve(crm, online, pos)
    c360 = idn.customer_360(st, ids)
    r = one(idn.completeness(st, ids, c360))
    # T3 has two sales: it is one row (amount counted once) and links both, as
    # it lacks the e-mail that each of them has; T4 has no sale: own id, no customer row
    assert r.returns_with_several_sales == 1 and r.returns_without_sale == 1
    assert r.records_without_customer_row == 1 and r.all_record_rows == 4
    assert [float(x.total_instore_spent_gbp) for x in c360.collect()] == [5.0]


POS_SCHEMA = ("transaction_id string, store_location string, transaction_date date, first_name string, "
              "last_name string, email string, phone string, loyalty_id string, staff_discount string, "
              "transaction_type string, amount_gbp double, order_reference string")


def _pos_roots(spark, rows):
    st = idn.stored(idn.stage(spark.createDataFrame([], idn_crm_schema()), spark.createDataFrame([], idn_online_schema()),
                              spark.createDataFrame(rows, POS_SCHEMA)))
    cc = idn.components(idn.all_records(st), receipts=idn.receipt_rows(st.pos))
    return {r.record_id: r.component_root for r in cc.collect()}


def test_receipt_links_only_keys_that_a_return_lacks(spark):
    sale = lambda t, email, phone, ref: (t, "S", None, "A", "B", email, phone, None, "No", "Sale", 1.0, ref)
    back = lambda t, email, phone, ref: (t, "S", None, "", "", email, phone, None, "No", "Return", -1.0, ref)
    rows = [sale("T1", "a@x", None, "R1"), sale("T2", "b@x", "07", "R1"), back("T3", "c@x", "", "R1"),   # lacks the phone only
            sale("T4", "d@x", None, "R2"), sale("T5", "e@x", None, "R2"),                                # no return
            sale("T6", None, None, "R3"), sale("T7", None, None, "R3"), back("T8", "", "", "R3"), back("T9", "", "", "R3"),
            sale("T10", "f@x", None, None), back("T11", "", "", None)]                                   # no receipt
    roots = _pos_roots(spark, rows)
    same = lambda a, b: roots[f"POS-{a}"] == roots[f"POS-{b}"]
    assert same("T2", "T3") and not same("T1", "T2") and not same("T4", "T5")
    assert len({roots[f"POS-T{i}"] for i in (6, 7, 8, 9, 10, 11)}) == 6


def test_customer_with_many_records_keeps_all(spark):
    rows = [(f"T{i:05d}", "S", None, "A", "B", "one@x", None, None, "No", "Sale", 1.0, f"R{i}") for i in range(10_500)]
    st, ids = idn.resolve(spark.createDataFrame([], idn_crm_schema()), spark.createDataFrame([], idn_online_schema()),
                          spark.createDataFrame(rows, POS_SCHEMA))
    assert idn.customer_records(ids).count() == 10_500
    c360 = idn.customer_360(st, ids)
    assert one(c360).n_source_records == 10_500
    assert idn.id_crosswalk(ids, c360, hot_rows=100).count() == 10_500


def test_id_width_grows_past_five_digits(spark):
    canon = spark.range(100_001).select(F.format_string("R%07d", "id").alias("record_id"),
                                         F.format_string("R%07d", "id").alias("component_root"))
    ids = idn.lookup_ids(canon)
    named = {r.record_id: r.omni_lookup_id for r in ids.collect()}
    assert named["R0100000"] == "OID-100001" and named["R0000000"] == "OID-00001" and len(set(named.values())) == 100_001


def idn_crm_schema():
    from meridian.sources.schemas import CRM
    return CRM


def idn_online_schema():
    from meridian.sources.schemas import ONLINE
    return ONLINE.replace("total_spent_gbp decimal(12,2)", "total_spent_gbp double")


def test_materialised_views_and_csv_sink(spark, resolved, tmp_path):
    from meridian.sources.io import read_csv, write_csv
    st, ids, c360 = resolved
    stored, cw = idn.materialise_customer_views(st, ids, str(tmp_path / "views"))
    assert stored.count() == 16 and cw.select("omni_lookup_id").distinct().count() == 16
    write_csv(stored.select("omni_lookup_id", "channel_segment"), str(tmp_path / "csv"))
    back = read_csv(spark, str(tmp_path / "csv"), "omni_lookup_id string, channel_segment string")
    assert back.count() == 16


def test_save_table_sink(spark, resolved):
    from meridian.sources.io import save_table
    name = "meridian_test_customer_360"
    try:
        t = save_table(resolved[2].select("omni_lookup_id", "channel_segment"), name)
        assert t.count() == 16
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _union_find(records):
    parent = {}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for r in records:
        parent.setdefault(r[0], r[0])
    first = {}
    for rid, *keys in records:
        for kind, v in enumerate(keys):
            if v is None:
                continue
            if (kind, v) in first:
                a, b = find(first[(kind, v)]), find(rid)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            else:
                first[(kind, v)] = rid
    return {r: find(r) for r in parent}


def test_hot_key_components_match_brute_force(spark):
    # a third of the records share one placeholder phone (hot key path forced)
    rows = []
    for i in range(30_000):
        phone = "0000" if i % 3 == 0 else None
        email = f"e{i // 2}" if i % 3 else None
        loyalty = f"L{i // 7}" if i % 5 == 0 else None
        rows.append((f"R{i:06d}", email, phone, loyalty))
    rec = spark.createDataFrame([(r, "pos", e, p, l) for r, e, p, l in rows],
                                "record_id string, source_system string, email_norm string, "
                                "phone_norm string, loyalty_id_norm string")
    got = {r.record_id: r.component_root for r in idn.components(rec, hot_rows=1_000).collect()}
    assert got == _union_find(rows)


def test_hot_paths_give_same_ids_and_crosswalk(fx, resolved):
    st, ids, c360 = resolved
    st2, ids2 = idn.resolve(fx("crm"), fx("online"), fx("pos"), hot_rows=1)
    assert {tuple(r) for r in ids2.collect()} == {tuple(r) for r in ids.collect()}
    a = {tuple(r) for r in idn.id_crosswalk(ids, c360, hot_rows=1).collect()}
    b = {tuple(r) for r in idn.id_crosswalk(ids, c360).collect()}
    assert a == b


def test_field_level_best_identity(spark):
    from meridian.sources.schemas import CRM, ONLINE
    crm = spark.createDataFrame([("L1", "Ann", "Lee", None, None, None, None, None, None, None, "Online",
                                  None, "Yes", "No")], CRM)
    online = spark.createDataFrame(
        [("77", "Ann", "Lee", "ann@x.com", None, "1 Road", None, None, None, "Yes", "L1", 1, 10.0, None, None)],
        ONLINE.replace("total_spent_gbp decimal(12,2)", "total_spent_gbp double"))
    pos = spark.createDataFrame([], "transaction_id string, store_location string, transaction_date date, "
                                    "first_name string, last_name string, email string, phone string, "
                                    "loyalty_id string, staff_discount string, transaction_type string, "
                                    "amount_gbp double, order_reference string")
    st, ids = idn.resolve(crm, online, pos)
    row = one(idn.best_identity(st, ids))
    assert (row.record_id, row.email, row.address) == ("CRM-L1", None, None)
    f = one(idn.best_identity(st, ids, field_level=True))
    assert (f.record_id, f.email, f.address, f.first_name) == ("CRM-L1", "ann@x.com", "1 Road", "Ann")


def test_hot_key_report(spark):
    rec = spark.createDataFrame([(f"R{i}", "pos", None, "0000" if i < 5 else f"07{i}", None) for i in range(8)],
                                "record_id string, source_system string, email_norm string, "
                                "phone_norm string, loyalty_id_norm string")
    rows = [tuple(r) for r in idn.hot_key_report(rec, min_records=3).collect()]
    assert rows == [("phone_norm", "0000", 5)]


def test_customer_ids_equal_customer_360_ids(resolved):
    st, ids, c360 = resolved
    a = {r[0] for r in idn.customer_ids(st, ids).collect()}
    assert a == {r.omni_lookup_id for r in c360.collect()}


def test_bucketed_tables_join_without_shuffle(spark, resolved):
    from meridian.sources.io import save_bucketed_table
    st, ids, _ = resolved
    names = ("meridian_test_ids_b", "meridian_test_records_b")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        a = save_bucketed_table(ids, names[0], ["record_id"], 4)
        b = save_bucketed_table(idn.all_records(st), names[1], ["record_id"], 4)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        j = b.join(a, "record_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and j.count() == 34
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_single_value_records_stay_out_of_the_graph(spark, monkeypatch):
    # 3,000 tills of one value each; two records tie a phone to an e-mail, one id comes twice
    rows = [(f"P{i:05d}", None, f"p{i % 30}", None) for i in range(3_000)]
    rows += [("Q1", "e1", "p1", None), ("Q2", "e1", "p2", None), ("Q3", None, "p7", None), ("Q3", None, None, "L7"),
             ("Q4", None, None, "L7"), ("Q5", None, None, None), (None, "e1", "p9", None)]
    rec = spark.createDataFrame([(r, "pos", e, p, l) for r, e, p, l in rows],
                                "record_id string, source_system string, email_norm string, "
                                "phone_norm string, loyalty_id_norm string")
    seen, real = [], idn.connected_components
    monkeypatch.setattr(idn, "connected_components", lambda n, e, **k: seen.append(n.count()) or real(n, e, **k))
    got = {r.record_id: r.component_root for r in idn.components(rec).collect()}
    assert seen == [5]          # e1, p1, p2; p7, L7
    assert got == _union_find([r for r in rows if r[0]])
    assert got["P00002"] == "P00001" and got["Q4"] == "P00007" and got["Q5"] == "Q5"
