"""Driver-table bindings: deterministic projections of the TPC-H-like tables
onto the inputs each operator expects (no hashing, no randomness, so the SQL
oracle can reproduce them exactly).

Each binding pre-aggregates before it shuffles: order lines are summed per
order before meeting ``orders``, orders per (customer, month) before meeting
``customer``. Per-customer windows only run after that pre-aggregation, so a
group holds at most one row per calendar month however hot the customer is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.sources.io import read_table

# Fixed values of the bindings (shared with the SQL oracle text).
CUPED_SPLIT_TS = "2024-01-16"
EVENTS_DAY0 = "2024-01-01"
CHURN_GAP_MONTHS = 12


def orders_range(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """First and last month (``yyyy-MM``) and the last day of ``orders``: one
    aggregate over its dates, one row to the driver."""
    day = F.to_date("o_orderdate")
    r = _t(spark, sf_dir, "orders").agg(F.min(day).alias("lo"), F.max(day).alias("hi")).collect()[0]
    lo, hi = str(r["lo"] or "1970-01-01"), str(r["hi"] or "1970-01-01")
    return lo[:7], hi[:7], hi


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def loyalty_code(key) -> "F.Column":
    return F.concat(F.lit("L"), F.lpad(key.cast("string"), 10, "0"))


# --------------------------------------------------------------------------- identity (B1-B3)
def crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    email = (F.when(k % 4 == 0, F.concat(F.lit(" U"), k.cast("string"), F.lit("@X.COM ")))
             .when(k % 2 == 0, F.concat(F.lit("u"), k.cast("string"), F.lit("@x.com"))))
    return c.select(
        loyalty_code(k).alias("loyalty_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        email.alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.lit(None).cast("string").alias("address"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("city"),
        F.lit(None).cast("string").alias("postcode"),
        F.lit(None).cast("string").alias("country"),
        F.lit(None).cast("date").alias("date_of_birth"),
        F.col("c_mktsegment").alias("signup_channel"),
        F.lit(None).cast("date").alias("signup_date"),
        F.when(k % 3 == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("email_consent"),
        F.lit("No").alias("sms_consent"))


def online(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    purchase = F.col("event_type") == "purchase"
    agg = e.groupBy("user_id").agg(
        F.count(F.when(purchase, F.lit(1))).alias("total_orders"),
        F.coalesce(F.sum(F.when(purchase, F.col("value"))), F.lit(0.0)).alias("total_spent_gbp"),
        F.min(F.to_date("ts")).alias("created_at"))
    u = F.col("user_id").cast("string")
    return agg.select(
        u.alias("customer_id"),
        F.lit("User").alias("first_name"),
        u.alias("last_name"),
        F.concat(F.lit("u"), u, F.lit("@x.com")).alias("email"),
        F.concat(F.lit("07 "), u).alias("phone"),
        F.lit(None).cast("string").alias("address"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("postcode"),
        F.lit(None).cast("string").alias("country"),
        F.lit("No").alias("accepts_marketing"),
        F.lit(None).cast("string").alias("loyalty_id"),
        "total_orders", "total_spent_gbp", "created_at",
        F.when(F.col("user_id") % 25 == 0, F.lit("wholesale")).otherwise(F.lit("retail")).alias("tags"))


def pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a till transaction: every 40th order is the return of
    the previous order's receipt (blank identity, negated amount), all others
    are sales; on every other such receipt the order before it is a sale too. Which identity fields a sale captured depends on the order key
    (phone, loyalty id, or neither); every 25th loyalty capture is mistyped as
    the next customer's id, which joins neighbouring customers."""
    o = _t(spark, sf_dir, "orders")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    ret = k % 40 == 0
    sale = ~ret
    blank = F.lit("")
    phone = F.when(ret, blank).when(k % 3 == 1, F.concat(F.lit("07"), ck.cast("string")))
    loyalty = (F.when(ret, blank)
               .when((k % 3 != 1) & (k % 7 != 0), loyalty_code(F.when(k % 25 == 0, ck + 1).otherwise(ck))))
    return o.select(
        k.cast("string").alias("transaction_id"),
        F.concat(F.lit("S"), (k % 7).cast("string")).alias("store_location"),
        F.to_date("o_orderdate").alias("transaction_date"),
        F.when(sale, F.lit("Cust")).otherwise(blank).alias("first_name"),
        F.when(sale, ck.cast("string")).otherwise(blank).alias("last_name"),
        F.when(ret, blank).cast("string").alias("email"),
        phone.alias("phone"),
        loyalty.alias("loyalty_id"),
        F.when(k % 60 == 5, F.lit("Yes")).otherwise(F.lit("No")).alias("staff_discount"),
        F.when(sale, F.lit("Sale")).otherwise(F.lit("Return")).alias("transaction_type"),
        F.when(sale, F.col("o_totalprice")).otherwise(-F.col("o_totalprice")).alias("amount_gbp"),
        F.concat(F.lit("RCT-"), F.when(ret, k - 1).when(k % 80 == 38, k + 1).otherwise(k).cast("string"))
        .alias("order_reference"))


# --------------------------------------------------------------------------- cohort (B4)
def customer_active_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (customer, month) pairs: the pre-aggregation every per-customer
    window below runs on (at most one row per month per customer)."""
    o = _t(spark, sf_dir, "orders")
    return (o.select(F.col("o_custkey").alias("custkey"),
                     F.trunc("o_orderdate", "month").alias("month"),
                     F.col("o_totalprice"))
            .groupBy("custkey", "month").agg(F.sum("o_totalprice").alias("revenue"),
                                             F.count(F.lit(1)).alias("n_orders")))


def host_cohort_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: signup month and the offset (months since signup
    + 1) of the first month followed by >= 12 inactive months; NULL if none."""
    m = customer_active_months(spark, sf_dir)
    w = Window.partitionBy("custkey").orderBy("month")
    nxt = F.coalesce(F.lead("month").over(w), F.to_date(F.lit(orders_range(spark, sf_dir)[1] + "-01")))
    gaps = m.select("custkey", "month",
                    F.months_between(nxt, F.col("month")).cast("int").alias("gap"))
    per = gaps.groupBy("custkey").agg(
        F.min("month").alias("signup"),
        F.min(F.when(F.col("gap") >= CHURN_GAP_MONTHS, F.col("month"))).alias("churn_month"))
    return per.select(
        F.col("custkey").cast("string").alias("host_id"),
        F.date_format("signup", "yyyy-MM").alias("signup_month"),
        (F.months_between("churn_month", "signup") + F.lit(1)).cast("double").alias("churned_month_offset"))


# --------------------------------------------------------------------------- CUPED (B5)
def cuped_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    pre = F.col("ts") < F.to_timestamp(F.lit(CUPED_SPLIT_TS))
    agg = e.groupBy("user_id").agg(
        F.coalesce(F.sum(F.when(pre, F.col("value"))), F.lit(0.0)).alias("x_pre_sessions"),
        F.coalesce(F.sum(F.when(~pre, F.col("value"))), F.lit(0.0)).alias("y_post_sessions"))
    return agg.select(
        F.col("user_id").cast("string").alias("user"),
        F.when(F.col("user_id") % 2 == 1, F.lit("Treatment")).otherwise(F.lit("Control")).alias("arm"),
        "x_pre_sessions", "y_post_sessions")


def cuped_users_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same users; those without a value before the split, and every
    seventh, have no covariate."""
    return cuped_users(spark, sf_dir).withColumn(
        "x_pre_sessions", F.when(F.col("x_pre_sessions") != 0, F.when(F.col("user").cast("long") % 7 != 0, F.col("x_pre_sessions"))))


# --------------------------------------------------------------------------- switchback (B6)
def switchback_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as a (zone, day-block, minute) panel; 1440-minute blocks."""
    e = _t(spark, sf_dir, "events")
    d = F.datediff(F.to_date("ts"), F.to_date(F.lit(EVENTS_DAY0))).cast("long")
    z = F.col("user_id") % 4
    arm = F.when((F.expr("(d * (d + 1)) div 2") + F.col("z")) % 2 == 1, F.lit("Treatment")) \
        .otherwise(F.lit("Control"))
    return (e.select(d.alias("d"), z.alias("z"), F.col("ts"), F.col("value"))
            .select(F.concat(F.lit("Z"), F.col("z").cast("string")).alias("zone"),
                    F.col("d").alias("block_id"),
                    arm.alias("assignment"),
                    (F.hour("ts") * 60 + F.minute("ts")).cast("long").alias("minutes_into_block"),
                    F.col("value").alias("wait_time_min"),
                    F.col("ts")))


# --------------------------------------------------------------------------- RDD (B7)
def rdd_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    c = _t(spark, sf_dir, "customer")
    spend = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("o_totalprice").alias("annual_spend"))
    return c.join(spend, "c_custkey").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_acctbal").alias("points_score"),
        "annual_spend",
        F.when(F.col("c_acctbal") >= 5000, F.lit("Gold")).otherwise(F.lit("Silver")).alias("status"))


def orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as text, as a file without types has it: each 97th price
    can't be read, each 89th day isn't in the calendar."""
    k = F.col("o_orderkey")
    text = [F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")]
    return _t(spark, sf_dir, "orders").select(
        *text, F.when(k % 97 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(k % 89 == 0, F.lit("1997-02-30")).otherwise(F.to_date("o_orderdate").cast("string")).alias("o_orderdate"))


# --------------------------------------------------------------------------- CAC (B8, B9)
GUEST_SEGMENTS = ("BUILDING", "AUTOMOBILE")


def cac_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month, side, spend, acquisitions): spend = discount value / 1000,
    acquisitions = distinct ordering customers in the month."""
    li = _t(spark, sf_dir, "lineitem")
    o = _t(spark, sf_dir, "orders")
    c = _t(spark, sf_dir, "customer")
    per_order = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("disc"))
    per_cust_month = (o.select("o_orderkey", "o_custkey",
                               F.date_format("o_orderdate", "yyyy-MM").alias("month"))
                      .join(per_order, "o_orderkey", "left")
                      .groupBy("o_custkey", "month")
                      .agg(F.coalesce(F.sum("disc"), F.lit(0.0)).alias("disc")))
    side = F.when(F.col("c_mktsegment").isin(*GUEST_SEGMENTS), F.lit("guest")).otherwise(F.lit("host"))
    return (per_cust_month.join(c.select(F.col("c_custkey").alias("o_custkey"), side.alias("side")),
                                "o_custkey")
            .groupBy("month", "side")
            .agg((F.sum("disc") / F.lit(1000.0)).alias("spend"),
                 F.count(F.lit(1)).alias("acquisitions")))


def host_ramp(spark: SparkSession, sf_dir: str, months: int = 6) -> DataFrame:
    """(host_id, month_since_signup, monthly_revenue) for the first ``months``
    months after a customer's first order (active months only)."""
    m = customer_active_months(spark, sf_dir)
    first = F.min("month").over(Window.partitionBy("custkey"))
    since = (F.months_between(F.col("month"), first) + F.lit(1)).cast("long")
    return (m.select(F.col("custkey").cast("string").alias("host_id"),
                     since.alias("month_since_signup"),
                     F.col("revenue").alias("monthly_revenue"))
            .where(F.col("month_since_signup") <= months))


# --------------------------------------------------------------------------- segmentation (B10-B12)
def rule_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("customer_id"),
                    (F.lit(18) + F.col("c_custkey") % 60).cast("long").alias("age"),
                    F.col("c_acctbal").alias("annual_spend"))


def rfm_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    agg = o.groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("last"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("o_totalprice").alias("monetary"))
    return agg.select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        (F.datediff(F.to_date(F.lit(orders_range(spark, sf_dir)[2])), F.to_date("last")) + 1)
        .cast("long").alias("recency_days"),
        "frequency", "monetary")


def kmeans_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rfm_customers(spark, sf_dir)
    return r.select("customer_id", F.col("monetary").alias("annual_spend"),
                    F.col("frequency").cast("double").alias("purchase_frequency"))
