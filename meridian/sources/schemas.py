"""Explicit schemas for the CSV inputs the operators were designed around.

Schemas are DDL strings accepted by ``DataFrameReader.schema``. The reader's
own inference is never used (``infer.py`` has one that keeps codes as text): it turns phone numbers and numeric customer
ids into ``bigint`` and loses the leading ``+`` / ``0``.
"""



def _schema(spec: str) -> str:
    """DDL text; Spark parses it at read time (no session needed at import)."""
    return spec


CRM = _schema(
    "loyalty_id string, first_name string, last_name string, email string, phone string, "
    "address string, city string, postcode string, country string, date_of_birth date, "
    "signup_channel string, signup_date date, email_consent string, sms_consent string")

ONLINE = _schema(
    "customer_id string, first_name string, last_name string, email string, phone string, "
    "address string, city string, postcode string, country string, accepts_marketing string, "
    "loyalty_id string, total_orders long, total_spent_gbp decimal(12,2), created_at date, "
    "tags string")

POS = _schema(
    "transaction_id string, store_location string, transaction_date date, first_name string, "
    "last_name string, email string, phone string, loyalty_id string, staff_discount string, "
    "transaction_type string, amount_gbp decimal(12,2), order_reference string")

CUPED = _schema("user string, arm string, x_pre_sessions long, y_post_sessions long")

RULE_CUSTOMERS = _schema("customer_id string, age long, annual_spend double")

RFM_CUSTOMERS = _schema("customer_id string, recency_days long, frequency long, monetary double")

KMEANS_CUSTOMERS = _schema("customer_id string, annual_spend double, purchase_frequency double")

CAC_SPEND = _schema("month string, side string, spend double, acquisitions long")

HOST_RAMP = _schema("host_id string, month_since_signup long, monthly_revenue double")

RDD = _schema("customer_id string, points_score long, annual_spend double, status string")

# Cohort events arrive with a text offset that is coerced leniently.
COHORT_EVENTS_RAW = _schema("host_id string, signup_month string, churned_month_offset string")

SWITCHBACK = _schema(
    "zone string, block_id long, assignment string, minutes_into_block long, wait_time_min double")

BY_NAME = {
    "crm": CRM, "online": ONLINE, "pos": POS, "cuped": CUPED,
    "rule_customers": RULE_CUSTOMERS, "rfm_customers": RFM_CUSTOMERS,
    "kmeans_customers": KMEANS_CUSTOMERS, "cac_spend": CAC_SPEND, "host_ramp": HOST_RAMP,
    "rdd": RDD, "cohort_events": COHORT_EVENTS_RAW, "switchback": SWITCHBACK,
}
