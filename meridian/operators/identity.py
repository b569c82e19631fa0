"""Cross-channel identity resolution (Q1-Q10).

Records from three channels (CRM, online orders, in-store POS) are
normalised, linked when they share a loyalty id, e-mail or phone, grouped
into connected components (one component = one customer), given a dense
``OID-nnnnn`` id, and rolled up to one row per customer plus a crosswalk.

Scale choices:

* Linking uses star edges: every record carrying a key value is linked to the
  smallest record id carrying it (k - 1 edges per value instead of the
  k(k-1)/2 pairs of a self-join). Components are identical.
* Components come from the large-star / small-star iteration in
  ``operators.graph`` (checkpointed rounds, polylog round count).
* The dense id is computed without a single-task global window
  (``functions.ranking``).
* Every per-customer roll-up is an aggregate keyed by the customer id
  (partial aggregation handles a giant customer); the best identity row is a
  ``min`` over a (priority, record id, fields) struct instead of a
  ``row_number`` window, which would put a giant customer in one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.common import attach_scalars
from meridian.functions.joins import DEFAULT_HOT_ROWS, hot_split_join
from meridian.functions.ranking import dense_rank_values
from meridian.operators.graph import connected_components
from meridian.session import checkpointed, written
from meridian.sources.store import Store

# Record-id prefixes, source names and priorities, flag texts.
PREFIX = {"crm": "CRM-", "online": "ONLINE-", "pos": "POS-"}
PRIORITY = {"crm": 1, "online": 2, "pos": 3}
ID_PREFIX = "OID-"
MIN_ID_WIDTH = 5
WHOLESALE_FLAG = "Possible corporate/bulk — review"
STAFF_FLAG = "Staff purchase"
REVIEW_FLAG = "Review: conflicting contact details across matched records"
OK_FLAG = "OK"
KEY_KINDS = ("loyalty_id_norm", "email_norm", "phone_norm")
CHANNEL_BOTH, CHANNEL_ONLINE = "Omnichannel", "Online only"
CHANNEL_STORE, CHANNEL_NONE = "In-store only", "Unknown"
LIST_SEPARATOR = "; "

RECORDS_PER_CHUNK = 10          # of a customer's record list, a row each
LISTED_RECORDS = 1000           # in the list of the customer_360 row itself


# --------------------------------------------------------------------------- Q1 normalise
def norm_email(c: Column) -> Column:
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def norm_phone(c: Column) -> Column:
    return F.nullif(F.translate(c, " -+", ""), F.lit(""))


def norm_id(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def _keys(email: str = "email", phone: str = "phone", loyalty: str = "loyalty_id") -> list[Column]:
    return [norm_email(F.col(email)).alias("email_norm"),
            norm_phone(F.col(phone)).alias("phone_norm"),
            norm_id(F.col(loyalty)).alias("loyalty_id_norm")]


def _raw() -> list[Column]:
    return [F.col("email").alias("raw_email"), F.col("phone").alias("raw_phone"),
            F.col("loyalty_id").alias("raw_loyalty_id")]


def stage_online(online: DataFrame) -> DataFrame:
    return online.select(
        F.concat(F.lit(PREFIX["online"]), F.col("customer_id").cast("string")).alias("record_id"),
        F.lit("online").alias("source_system"), *_keys(), "first_name", "last_name", *_raw(),
        "address", "city", "postcode", "country", "total_orders", "total_spent_gbp", "tags")


def stage_crm(crm: DataFrame) -> DataFrame:
    return crm.select(
        F.concat(F.lit(PREFIX["crm"]), F.col("loyalty_id")).alias("record_id"),
        F.lit("crm").alias("source_system"), *_keys(), "first_name", "last_name", *_raw(),
        "address", "city", "postcode", "country", "signup_channel", "email_consent", "sms_consent")


POS_COLS = ["record_id", "source_system", "email_norm", "phone_norm", "loyalty_id_norm",
            "first_name", "last_name", "raw_email", "raw_phone", "raw_loyalty_id",
            "transaction_type", "staff_discount", "amount_gbp", "order_reference"]


def stage_pos(pos: DataFrame) -> DataFrame:
    """POS records; a return inherits the normalised keys and the name of a
    sale with the same order reference (raw contact fields stay as they are).

    A return is one row, so its amount counts once: it inherits from the sale
    with the smallest record id. It still *links* all sales of its receipt
    that hold a key it lacks: ``link_kinds`` names these keys, and
    ``receipt_rows`` ties them through the receipt. ``completeness`` reports
    how many returns had several sales.
    """
    raw = pos.select(
        F.concat(F.lit(PREFIX["pos"]), F.col("transaction_id")).alias("record_id"),
        F.lit("pos").alias("source_system"), *_keys(), "first_name", "last_name", *_raw(),
        "transaction_type", "staff_discount", "amount_gbp", "order_reference")
    inherit = ("email_norm", "phone_norm", "loyalty_id_norm", "first_name", "last_name")
    is_return, has_ref = F.col("transaction_type") == "Return", F.col("order_reference").isNotNull()
    # one row per order reference (partial aggregation, skew-safe)
    sales = (raw.where((F.col("transaction_type") == "Sale") & has_ref)
             .groupBy("order_reference")
             .agg(F.min(F.struct("record_id", *inherit)).alias("s"), F.count(F.lit(1)).alias("n_sales"),
                  *[F.max(F.col(k).isNotNull()).alias(f"_has_{k}") for k in KEY_KINDS]))
    ret = raw.where(is_return & has_ref).join(sales, "order_reference", "left")
    lacking = F.array_compact(F.array(*[
        F.when((F.col("n_sales") > 1) & F.col(k).isNull() & F.col(f"_has_{k}"), F.lit(k)) for k in KEY_KINDS]))
    fixed = ret.select(
        "record_id", "source_system",
        F.coalesce("email_norm", "s.email_norm").alias("email_norm"),
        F.coalesce("phone_norm", "s.phone_norm").alias("phone_norm"),
        F.coalesce("loyalty_id_norm", "s.loyalty_id_norm").alias("loyalty_id_norm"),
        F.coalesce(F.nullif("first_name", F.lit("")), "s.first_name").alias("first_name"),
        F.coalesce(F.nullif("last_name", F.lit("")), "s.last_name").alias("last_name"),
        "raw_email", "raw_phone", "raw_loyalty_id", "transaction_type", "staff_discount",
        "amount_gbp", "order_reference", F.coalesce("n_sales", F.lit(0)).alias("matched_sales"),
        lacking.alias("link_kinds"))
    none = F.lit(None).cast("array<string>").alias("link_kinds")
    # returns without a reference match nothing and never enter the join
    alone = raw.where(is_return & ~has_ref).select(
        *[c for c in POS_COLS if c not in ("first_name", "last_name")],
        F.nullif("first_name", F.lit("")).alias("first_name"), F.nullif("last_name", F.lit("")).alias("last_name"),
        F.lit(0).cast("long").alias("matched_sales"), none)
    return (raw.where(F.col("transaction_type") != "Return")
            .select(*POS_COLS, F.lit(None).cast("long").alias("matched_sales"), none)
            .unionByName(fixed).unionByName(alone))


def receipt_rows(pos: DataFrame) -> DataFrame:
    """``(kind, value, record_id)`` tying a return to every sale of its
    receipt that holds a key the return lacks: one row per return or sale and
    key kind, valued by the receipt, so the links stay linear."""
    need = (pos.where(F.size("link_kinds") > 0)
            .select("order_reference", F.explode("link_kinds").alias("kind"), "record_id"))
    held = F.array_compact(F.array(*[F.when(F.col(k).isNotNull(), F.lit(k)) for k in KEY_KINDS]))
    sales = (pos.where(F.col("transaction_type") == "Sale")
             .select("order_reference", F.explode(held).alias("kind"), "record_id")
             .join(need.select("order_reference", "kind").distinct(), ["order_reference", "kind"], "left_semi"))
    return need.unionByName(sales).select(F.concat(F.lit("receipt "), "kind").alias("kind"),
                                          F.col("order_reference").alias("value"), "record_id")


@dataclass
class Staged:
    crm: DataFrame
    online: DataFrame
    pos: DataFrame


def stage(crm: DataFrame, online: DataFrame, pos: DataFrame) -> Staged:
    return Staged(stage_crm(crm), stage_online(online), stage_pos(pos))


def stored(st: Staged) -> Staged:
    """The staged channels written once: the graph and every roll-up read
    these instead of aggregating and repairing the base tables again."""
    return Staged(checkpointed(st.crm), checkpointed(st.online), checkpointed(st.pos))


def all_records(st: Staged) -> DataFrame:
    """Q1: one row per record ``(record_id, source_system, email_norm,
    phone_norm, loyalty_id_norm)``."""
    cols = ["record_id", "source_system", "email_norm", "phone_norm", "loyalty_id_norm"]
    return st.online.select(cols).unionByName(st.pos.select(cols)).unionByName(st.crm.select(cols))


# --------------------------------------------------------------------------- Q2 edges
def key_rows(records: DataFrame, id_col: str = "record_id") -> DataFrame:
    """(kind, value, record_id) for every non-null key of every record;
    ``id_col`` names the column that identifies it."""
    kv = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in KEY_KINDS]))
    return (records.select(F.col(id_col).alias("record_id"), kv.alias("kv"))
            .select(F.col("kv.kind").alias("kind"), F.col("kv.value").alias("value"), "record_id")
            .where(F.col("value").isNotNull()))


def star_edges(records: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS, distinct: bool = True,
               receipts: DataFrame | None = None, id_col: str = "record_id") -> DataFrame:
    """Q2: ``(record_id_a, record_id_b)``, a < b: each record linked to the
    smallest record id sharing one of its keys (the kind is part of the key,
    so an e-mail never matches a phone). Linear in the number of records,
    and it yields the same components as linking every pair. ``receipts``:
    further key rows (``receipt_rows``)."""
    kr = key_rows(records, id_col)
    if receipts is not None:
        kr = kr.unionByName(receipts)
    hubs = kr.groupBy("kind", "value").agg(F.min("record_id").alias("hub"))
    # hot key values (hot hubs) are found from a sample of the key rows
    linked = hot_split_join(kr, hubs, ["kind", "value"], hot_rows=hot_rows)
    out = (linked.where(F.col("record_id") != F.col("hub"))
           .select(F.col("hub").alias("record_id_a"), F.col("record_id").alias("record_id_b")))
    # the same pair can come from two key kinds; the graph step de-duplicates
    # on its own, so callers feeding it skip this shuffle
    return out.distinct() if distinct else out


# --------------------------------------------------------------------------- Q3, Q4 components and ids
def components(records: DataFrame, edges: DataFrame | None = None,
               hot_rows: int = DEFAULT_HOT_ROWS, receipts: DataFrame | None = None) -> DataFrame:
    """Q3: ``(record_id, component_root)``: root = smallest reachable id.
    Every record gets a root, including records with no shared key.

    Without ``edges``, key values are grouped instead of records: a record
    ties the values that it holds, so one with a single value, as most have,
    brings no edge, and a group's root is the smallest id of its records."""
    if edges is None:
        return _value_components(records, receipts, hot_rows)
    rank = checkpointed(dense_rank_values(records, "record_id", "_node").df)
    a = rank.select(F.col("record_id").alias("record_id_a"), F.col("_node").alias("_a"))
    b = rank.select(F.col("record_id").alias("record_id_b"), F.col("_node").alias("_b"))
    pairs = edges.join(a, "record_id_a").join(b, "record_id_b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    # the rounds run on dense ranks of the ids (longs in the same order),
    # which aggregate by hash and shuffle eight bytes
    cc = connected_components(rank.select(F.col("_node").alias("node")), pairs, hot_rows=hot_rows, contract=True)
    own = rank.select(F.col("_node").alias("node"), "record_id")
    roots = rank.select(F.col("_node").alias("root"), F.col("record_id").alias("component_root"))
    # few records share most roots, but one root may be that of a third of all
    named = hot_split_join(cc.join(own, "node"), roots, ["root"], hot_rows=hot_rows)
    return named.select("record_id", "component_root")


def _value_components(records: DataFrame, receipts: DataFrame | None, hot_rows: int) -> DataFrame:
    """``components`` through the key values that records hold.

    A value is a text, its kind before it. Every record id has its least value
    as its own; other values of its are tied to that. Ids whose values are all
    one make no edge. Values that no edge reaches are groups of their own."""
    def value(kind: Column | str, v: Column | str) -> Column:
        return F.concat(kind, F.lit(":"), v)

    known = F.col("record_id").isNotNull()
    held = F.array_compact(F.array(*[value(F.lit(k), F.col(k)) for k in KEY_KINDS]))
    rows = records.where(known).select("record_id", held.alias("held"))
    if receipts is not None:
        rows = rows.unionByName(receipts.where(known & F.col("value").isNotNull())
                                .select("record_id", F.array(value("kind", "value")).alias("held")))
    # one row per id, whether it has several values or not
    per = written(rows.groupBy("record_id").agg(F.min(F.array_min("held")).alias("value"), F.max(F.array_max("held")).alias("_top")))
    several = per.where(F.col("value") != F.col("_top")).select("record_id", F.col("value").alias("a"))
    ties = written(rows.select("record_id", F.explode("held").alias("b")).join(several, "record_id")
                   .where(F.col("a") != F.col("b")).select("a", "b"))
    rank = written(dense_rank_values(ties.select(F.explode(F.array("a", "b")).alias("value")), "value", "_node").df)
    pairs = ties
    for end in ("a", "b"):      # a value may be that of a third of all records
        pairs = hot_split_join(pairs, rank.select(F.col("value").alias(end), F.col("_node").alias(f"_{end}")), [end], hot_rows=hot_rows)
    pairs = pairs.select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    nodes = rank.select("value", F.col("_node").alias("node"))
    cc = connected_components(nodes.select("node"), pairs, hot_rows=hot_rows, contract=True)
    tied = nodes.join(cc, "node").select("value", "root")
    ids = per.select("record_id", "value")
    # a group is named by its root or, untied, by its one value
    found = hot_split_join(ids.where(F.col("value").isNotNull()), tied, ["value"], hot_rows=hot_rows, how="left")
    grouped = written(found.select("record_id", F.coalesce(F.col("root").cast("string"), F.col("value")).alias("_group")))
    roots = grouped.groupBy("_group").agg(F.min("record_id").alias("component_root"), F.count(F.lit(1)).alias("_size"))
    named = hot_split_join(grouped, roots, ["_group"], "_size", hot_rows=hot_rows)
    alone = ids.where(F.col("value").isNull())
    return (named.select("record_id", "component_root")
            .unionByName(alone.select("record_id", F.col("record_id").alias("component_root"))))


def lookup_ids(canonical: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Q4: ``(record_id, omni_lookup_id)``: ``OID-`` + dense rank of the
    component root, padded to five digits; longer ranks keep their digits, so
    no id depends on the number of customers."""
    rk = dense_rank_values(canonical, "component_root", "_rank", count_col="_size")
    digits = F.col("_rank").cast("string")
    ids = rk.df.select("component_root", "_size", F.concat(
        F.lit(ID_PREFIX), F.repeat(F.lit("0"), F.greatest(F.lit(0), F.lit(MIN_ID_WIDTH) - F.length(digits))), digits)
        .alias("omni_lookup_id"))
    # a giant component's records all carry one root: split that key off
    return (hot_split_join(canonical, ids, ["component_root"], "_size", hot_rows=hot_rows, big_rows=rk.n_rows)
            .select("record_id", "omni_lookup_id"))


# --------------------------------------------------------------------------- per-customer roll-ups
def record_detail(st: Staged) -> DataFrame:
    """Every record with the union of the columns the roll-ups need."""
    def pad(df: DataFrame, src: str) -> DataFrame:
        return df.withColumn("source_priority", F.lit(PRIORITY[src]))

    crm = pad(st.crm, "crm").select(
        "record_id", "source_system", "source_priority", "email_norm", "phone_norm",
        "first_name", "last_name", F.col("raw_email").alias("email"), F.col("raw_phone").alias("phone"),
        F.col("raw_loyalty_id").alias("loyalty_id"), "address", "city", "postcode", "country",
        "signup_channel", "email_consent", "sms_consent")
    onl = pad(st.online, "online").select(
        "record_id", "source_system", "source_priority", "email_norm", "phone_norm",
        "first_name", "last_name", F.col("raw_email").alias("email"), F.col("raw_phone").alias("phone"),
        F.col("raw_loyalty_id").alias("loyalty_id"), "address", "city", "postcode", "country",
        "total_orders", "total_spent_gbp", "tags")
    pos = pad(st.pos, "pos").select(
        "record_id", "source_system",
        # only sales can supply the identity row
        F.when(F.col("transaction_type") == "Sale", F.col("source_priority")).alias("source_priority"),
        "email_norm", "phone_norm", "first_name", "last_name",
        F.col("raw_email").alias("email"), F.col("raw_phone").alias("phone"),
        F.col("raw_loyalty_id").alias("loyalty_id"), "transaction_type", "staff_discount", "amount_gbp")
    return crm.unionByName(onl, allowMissingColumns=True).unionByName(pos, allowMissingColumns=True)


IDENTITY_FIELDS = ["first_name", "last_name", "email", "phone", "loyalty_id", "address", "city",
                   "postcode", "country", "signup_channel", "email_consent", "sms_consent"]


def detail_with_ids(st: Staged, ids: DataFrame) -> DataFrame:
    """``record_detail`` with the customer of each record."""
    return record_detail(st).join(ids, "record_id")


def match_quality(records: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Q5: distinct normalised e-mails / phones per customer and the flag.
    ``records`` already carrying ``omni_lookup_id`` are used as they are."""
    j = records if ids is None else records.select("record_id", "email_norm", "phone_norm").join(ids, "record_id")
    q = j.groupBy("omni_lookup_id").agg(F.countDistinct("email_norm").alias("distinct_emails"),
                                        F.countDistinct("phone_norm").alias("distinct_phones"))
    flag = F.when((F.col("distinct_emails") > 1) | (F.col("distinct_phones") > 1), F.lit(REVIEW_FLAG)) \
        .otherwise(F.lit(OK_FLAG))
    return q.withColumn("match_confidence", flag)


def _rollup(detail_ids: DataFrame) -> DataFrame:
    """One aggregate per customer: best identity row, channel activity and
    the record count."""
    is_onl = F.col("source_system") == "online"
    is_pos = F.col("source_system") == "pos"
    best = F.min(F.when(F.col("source_priority").isNotNull(),
                        F.struct("source_priority", "record_id", *IDENTITY_FIELDS))).alias("best")
    return detail_ids.groupBy("omni_lookup_id").agg(
        best,
        F.max(F.when(is_onl, F.lit(1))).alias("has_online"),
        F.sum(F.when(is_onl, F.col("total_orders"))).alias("total_online_orders"),
        F.sum(F.when(is_onl, F.col("total_spent_gbp"))).alias("total_online_spent_gbp"),
        F.max(F.when(is_onl, F.col("tags"))).alias("online_tags"),
        F.max(F.when(is_pos, F.lit(1))).alias("has_instore"),
        F.count(F.when(is_pos & (F.col("transaction_type") == "Sale"), F.lit(1))).alias("_n_sales"),
        F.sum(F.when(is_pos, F.col("amount_gbp"))).alias("total_instore_spent_gbp"),
        F.max(F.when(is_pos, F.when(F.col("staff_discount") == "Yes", 1).otherwise(0))).alias("is_staff"),
        F.count(F.lit(1)).alias("n_source_records"),
        # "more than one distinct value" needs no set: the least differs from the greatest
        (F.coalesce(F.min("email_norm") != F.max("email_norm"), F.lit(False))
         | F.coalesce(F.min("phone_norm") != F.max("phone_norm"), F.lit(False))).alias("_conflict"))


def _activity_columns() -> list[Column]:
    """Channel flags, segment, totals and the segment flag from ``_rollup``
    columns. Wholesale wins over staff; CRM-only customers are Unknown."""
    has_onl = F.coalesce(F.col("has_online"), F.lit(0))
    has_pos = F.coalesce(F.col("has_instore"), F.lit(0))
    return [
        has_onl.alias("has_online_activity"), has_pos.alias("has_instore_activity"),
        F.when((has_onl == 1) & (has_pos == 1), CHANNEL_BOTH).when(has_onl == 1, CHANNEL_ONLINE)
        .when(has_pos == 1, CHANNEL_STORE).otherwise(CHANNEL_NONE).alias("channel_segment"),
        F.col("total_online_orders"), F.col("total_online_spent_gbp"),
        F.when(F.col("has_instore") == 1, F.col("_n_sales")).alias("total_instore_transactions"),
        F.col("total_instore_spent_gbp"),
        (F.coalesce("total_online_spent_gbp", F.lit(0)) + F.coalesce("total_instore_spent_gbp", F.lit(0)))
        .alias("total_lifetime_spent_gbp"),
        F.when(F.col("online_tags").like("%wholesale%"), F.lit(WHOLESALE_FLAG))
        .when(F.col("is_staff") == 1, F.lit(STAFF_FLAG)).alias("segment_flag"),
    ]


def customer_360(st: Staged | None, ids: DataFrame | None, detail: DataFrame | None = None,
                 lists: DataFrame | None = None) -> DataFrame:
    """Q8: one row per customer that has at least one CRM, online or POS-sale
    record, with the highest-priority source's identity fields (whole row of
    the best record, ties broken by record id), channel activity, spend,
    flags, match confidence and the number of merged records, all from one
    aggregate. The records themselves are the rows of ``customer_records``.

    ``detail``: stored ``detail_with_ids``. With ``lists`` (``record_lists``)
    a row also has ``matched_source_record_ids``, the list of its first
    ``LISTED_RECORDS`` records; a longer list goes on in ``lists``."""
    detail = detail_with_ids(st, ids) if detail is None else detail
    r = _rollup(detail).where(F.col("best").isNotNull())
    out = r.select("omni_lookup_id", *[F.col(f"best.{c}").alias(c) for c in IDENTITY_FIELDS],
                   *_activity_columns(),
                   F.when(F.col("_conflict"), F.lit(REVIEW_FLAG)).otherwise(F.lit(OK_FLAG)).alias("match_confidence"),
                   "n_source_records")
    return out if lists is None else out.join(joined_lists(lists), "omni_lookup_id", "left")


def _source_of(rid: Column) -> tuple[Column, Column]:
    """The source system and native id that a record id names."""
    system, native = None, None
    for src, pre in PREFIX.items():
        hit, rest = rid.startswith(pre), F.substr(rid, F.lit(len(pre) + 1))
        system = F.when(hit, src) if system is None else system.when(hit, src)
        native = F.when(hit, rest) if native is None else native.when(hit, rest)
    return system, native


def customer_records(ids: DataFrame) -> DataFrame:
    """The audit trail: ``(omni_lookup_id, source_system, record_id)`` for
    every merged record of every customer."""
    return ids.select("omni_lookup_id", _source_of(F.col("record_id"))[0].alias("source_system"), "record_id")


def record_lists(ids: DataFrame, chunk: int = RECORDS_PER_CHUNK, num_partitions: int | None = None,
                 hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Each customer's record ids in order, ``chunk`` of them a row:
    ``(omni_lookup_id, chunk_no, record_ids, n_records)``.

    A record's place among its customer's comes from a rank in two levels:
    all records are sorted by range partitions of (customer, record id), which
    cut a giant customer as well, and numbered within; the sizes of the
    partitions before (one number each) make that a number over all, and the
    smallest number of a customer is taken off. So no customer's records meet
    in one task: only those of a chunk are gathered."""
    spark = ids.sparkSession
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = checkpointed(
        ids.select("omni_lookup_id", "record_id").repartitionByRange(n_parts, "omni_lookup_id", "record_id")
        .sortWithinPartitions("omni_lookup_id", "record_id")
        .select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")))
    sizes = sorted((r["_pid"], r["count"]) for r in placed.groupBy("_pid").count().collect())
    before = [0, *accumulate(n for _, n in sizes)]
    offsets = spark.createDataFrame([(p, off) for (p, _), off in zip(sizes, before)], "_pid int, _off long")
    place = F.col("_off") + F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    numbered = placed.join(F.broadcast(offsets), "_pid").select("omni_lookup_id", "record_id", place.alias("_place"))
    first = numbered.groupBy("omni_lookup_id").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    total = before[-1]
    own = hot_split_join(numbered, first, ["omni_lookup_id"], "_n", hot_rows=hot_rows, big_rows=total)
    at = F.col("_place") - F.col("_first")
    listed = F.array_sort(F.collect_list(F.struct("_place", "record_id")))
    return (own.groupBy("omni_lookup_id", F.floor(at / chunk).alias("chunk_no"))
            .agg(F.array_join(listed.getField("record_id"), LIST_SEPARATOR).alias("record_ids"),
                 F.count(F.lit(1)).alias("n_records")))


def joined_lists(lists: DataFrame, records: int = LISTED_RECORDS, chunk: int = RECORDS_PER_CHUNK) -> DataFrame:
    """``(omni_lookup_id, matched_source_record_ids)``: the first chunks of
    each customer's list as one, of at most ``records`` ids."""
    first = F.array_sort(F.collect_list(F.struct("chunk_no", "record_ids")))
    return (lists.where(F.col("chunk_no") < records // chunk).groupBy("omni_lookup_id")
            .agg(F.array_join(first.getField("record_ids"), LIST_SEPARATOR).alias("matched_source_record_ids")))


def split_lists(lists: DataFrame) -> DataFrame:
    """The stored lists back as rows, ``(omni_lookup_id, record_id)``: one per
    item, trimmed; empty items are none."""
    return (lists.select("omni_lookup_id", F.explode(F.split("record_ids", LIST_SEPARATOR.strip())).alias("item"))
            .select("omni_lookup_id", F.trim("item").alias("record_id")).where(F.col("record_id") != ""))


def list_check(lists: DataFrame, ids: DataFrame) -> DataFrame:
    """One row that holds lists against the record -> customer map they were
    made of: customers, chunks and items, customers whose items are not as
    many as their records, and items that are no record of their customer."""
    items = split_lists(lists)
    per = (items.groupBy("omni_lookup_id").agg(F.count(F.lit(1)).alias("listed"))
           .join(ids.groupBy("omni_lookup_id").agg(F.count(F.lit(1)).alias("held")), "omni_lookup_id", "full"))
    counts = per.agg(F.count(F.lit(1)).alias("customers"), F.coalesce(F.sum("listed"), F.lit(0)).alias("items"),
                     F.count(F.when(~F.col("listed").eqNullSafe(F.col("held")), 1)).alias("customers_with_other_count"))
    strange = items.join(ids, ["record_id", "omni_lookup_id"], "left_anti").agg(F.count(F.lit(1)).alias("unknown_items"))
    out = attach_scalars(counts, lists.agg(F.count(F.lit(1)).alias("chunks"), F.max("n_records").alias("longest_chunk")))
    return attach_scalars(out, strange)


def best_identity(st: Staged | None, ids: DataFrame | None, field_level: bool = False,
                  detail: DataFrame | None = None) -> DataFrame:
    """Q6: ``(omni_lookup_id, source_priority, record_id, identity fields)``.

    Default: the whole row of the best record (lowest priority, then record
    id), so a missing CRM e-mail stays missing. ``field_level=True`` fills
    each field from the best record that has it instead (``source_priority``
    and ``record_id`` then describe the best record overall)."""
    detail = detail_with_ids(st, ids) if detail is None else detail
    d = detail.where(F.col("source_priority").isNotNull())
    if not field_level:
        b = (d.groupBy("omni_lookup_id")
             .agg(F.min(F.struct("source_priority", "record_id", *IDENTITY_FIELDS)).alias("best")))
        return b.select("omni_lookup_id", "best.*")
    per_field = [F.min(F.when(F.col(c).isNotNull(), F.struct("source_priority", "record_id", c)))
                 .getField(c).alias(c) for c in IDENTITY_FIELDS]
    best = F.min(F.struct("source_priority", "record_id")).alias("best")
    b = d.groupBy("omni_lookup_id").agg(best, *per_field)
    return b.select("omni_lookup_id", "best.source_priority", "best.record_id", *IDENTITY_FIELDS)


def hot_key_report(records: DataFrame, min_records: int = 1000) -> DataFrame:
    """Data-quality output: key values shared by at least ``min_records``
    records (placeholder phones, shared mailboxes). Nothing is dropped; the
    report is one partially aggregated ``groupBy(kind, value)``."""
    return (key_rows(records).groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") >= min_records))


def channel_activity(st: Staged | None, ids: DataFrame | None, detail: DataFrame | None = None) -> DataFrame:
    """Q7: per customer (every id, including return-only ones): activity
    flags, channel segment, order and spend totals, segment flag."""
    r = _rollup(detail_with_ids(st, ids) if detail is None else detail)
    return r.select("omni_lookup_id", *_activity_columns())


def customer_ids(st: Staged, ids: DataFrame) -> DataFrame:
    """The customers that get a ``customer_360`` row: those with at least one
    CRM, online or POS-sale record (return-only customers have none)."""
    eligible = (st.crm.select("record_id").unionByName(st.online.select("record_id"))
                .unionByName(st.pos.where(F.col("transaction_type") == "Sale").select("record_id")))
    return ids.join(eligible, "record_id", "left_semi").select("omni_lookup_id").distinct()


# --------------------------------------------------------------------------- Q9, Q10
def id_crosswalk(ids: DataFrame, customers: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Q9: ``(omni_lookup_id, loyalty_id, online_customer_id,
    pos_transaction_id)``: one row per POS record of a customer, or one row
    with a NULL transaction when the customer has none. The native id is
    everything after the source prefix. Built from the
    materialised record -> id map, restricted to customers present in
    ``customers`` (the stored customer_360)."""
    system, native = _source_of(F.col("record_id"))
    tagged = (hot_split_join(ids, customers.select("omni_lookup_id"), ["omni_lookup_id"], hot_rows=hot_rows, how="left_semi")
              .select("omni_lookup_id", system.alias("source_system"), native.alias("native_id")))
    is_pos = F.col("source_system") == "pos"
    scalars = tagged.groupBy("omni_lookup_id").agg(
        F.max(F.when(F.col("source_system") == "crm", F.col("native_id"))).alias("loyalty_id"),
        F.max(F.when(F.col("source_system") == "online", F.col("native_id"))).alias("online_customer_id"),
        F.count(F.when(is_pos, F.lit(1))).alias("_n_pos"))
    pos = tagged.where(is_pos).select("omni_lookup_id", F.col("native_id").alias("pos_transaction_id"))
    # POS rows carry the customer's scalars (many-to-one; a customer with a
    # huge number of transactions is joined map-side), customers without POS
    # keep one row with a NULL transaction
    with_pos = hot_split_join(pos, scalars, ["omni_lookup_id"], hot_rows=hot_rows)
    without = scalars.where(F.col("_n_pos") == 0).select(
        "omni_lookup_id", "loyalty_id", "online_customer_id",
        F.lit(None).cast("string").alias("pos_transaction_id"))
    cols = ["omni_lookup_id", "loyalty_id", "online_customer_id", "pos_transaction_id"]
    return with_pos.select(cols).unionByName(without.select(cols))


def completeness(st: Staged, ids: DataFrame, customers: DataFrame) -> DataFrame:
    """Q10: row counts per source and of the customer table, plus invariant
    checks: records without an id, records with more than one id, records
    whose customer has no customer_360 row (return-only customers), returns
    that matched no sale and returns whose reference had several sales."""
    records = all_records(st)
    per_record = records.join(ids, "record_id", "left").groupBy("record_id").agg(
        F.countDistinct("omni_lookup_id").alias("k"))
    counts = per_record.agg(F.count(F.when(F.col("k") == 0, 1)).alias("records_without_id"),
                            F.count(F.when(F.col("k") > 1, 1)).alias("records_with_multiple_ids"))
    rets = st.pos.where(F.col("transaction_type") == "Return").agg(
        F.count(F.when(F.col("matched_sales") == 0, 1)).alias("returns_without_sale"),
        F.count(F.when(F.col("matched_sales") > 1, 1)).alias("returns_with_several_sales"))
    orphan = (hot_split_join(ids, customers.select("omni_lookup_id"), ["omni_lookup_id"], how="left_anti")
              .agg(F.count(F.lit(1)).alias("records_without_customer_row")))
    srcs = records.agg(
        F.count(F.when(F.col("source_system") == "online", 1)).alias("online_rows"),
        F.count(F.when(F.col("source_system") == "crm", 1)).alias("crm_rows"),
        F.count(F.lit(1)).alias("all_record_rows"))
    sales = st.pos.agg(F.count(F.when(F.col("transaction_type") == "Sale", 1)).alias("pos_sale_rows"))
    cust = customers.agg(F.count(F.lit(1)).alias("customer_360_rows"))
    out = srcs
    for t in (sales, cust, counts, orphan, rets):
        out = attach_scalars(out, t)
    return out


def resolve(crm: DataFrame, online: DataFrame, pos: DataFrame,
            hot_rows: int = DEFAULT_HOT_ROWS) -> tuple[Staged, DataFrame]:
    """Stage the channels and build the materialised ``record -> customer
    id`` map (checkpointed: it feeds every roll-up)."""
    st = stored(stage(crm, online, pos))
    ids = checkpointed(lookup_ids(components(all_records(st), hot_rows=hot_rows, receipts=receipt_rows(st.pos)),
                                  hot_rows=hot_rows))
    return st, ids


class Views:
    """The resolution of three channels and what is derived from it, each
    table worked out once and read back from a ``Store``: by a later query of
    the session or, with a ``root``, of any session. Inputs are recognised by
    their files; changed ones are resolved anew."""

    def __init__(self, crm: DataFrame, online: DataFrame, pos: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS,
                 root: str | None = None) -> None:
        self.store = Store(crm, online, pos, salt="identity", root=root)
        self._raw, self._hot = stage(crm, online, pos), hot_rows

    @cached_property
    def staged(self) -> Staged:
        raw, table = self._raw, self.store.table
        return Staged(table("crm", lambda: raw.crm), table("online", lambda: raw.online), table("pos", lambda: raw.pos))

    @cached_property
    def components(self) -> DataFrame:
        return self.store.table("components", lambda: components(
            all_records(self.staged), hot_rows=self._hot, receipts=receipt_rows(self.staged.pos)))

    @cached_property
    def ids(self) -> DataFrame:
        return self.store.table("ids", lambda: lookup_ids(self.components, self._hot))

    @cached_property
    def detail(self) -> DataFrame:
        """Every record with its customer and what the roll-ups need."""
        return self.store.table("detail", lambda: detail_with_ids(self.staged, self.ids))

    @cached_property
    def lists(self) -> DataFrame:
        return self.store.table("lists", lambda: record_lists(self.ids, hot_rows=self._hot))

    @cached_property
    def customers(self) -> DataFrame:
        """The stored customer_360, with its record lists."""
        return self.store.table("customer_360", lambda: customer_360(None, None, self.detail, self.lists))


def materialise_customer_views(st: Staged, ids: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write ``customer_360`` and the record -> id map as Parquet under
    ``path`` (shared storage), then build the crosswalk from the stored
    tables instead of re-running the matching. Returns ``(customer_360,
    crosswalk)`` read back from storage."""
    from meridian.sources.io import materialise
    c360 = materialise(customer_360(st, ids), f"{path}/customer_360")
    stored_ids = materialise(ids, f"{path}/record_to_customer")
    cw = materialise(id_crosswalk(stored_ids, c360), f"{path}/id_crosswalk")
    return c360, cw
