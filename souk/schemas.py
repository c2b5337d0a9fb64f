"""Fixed table schemas (the schema contract) and domain constants.

Types follow the warehouse DDL: VARCHAR -> string, NUMERIC(p,s) -> decimal(p,s),
counts stored as INT.  Nothing is inferred: every read uses one of these.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the source system's) --------------------------
STATUSES = ("completed", "pending", "cancelled", "refunded")
EXCLUDED_STATUS = "cancelled"
ANOMALY_THRESHOLD_PCT = 30
MOVING_AVG_DAYS = 7
ACTIVE_WINDOW_DAYS = 30
ALERT_EVENT = "anomaly_detected"
TOP_N = 10
# VARCHAR(n) limits and NUMERIC(p,s) domains of the staging tables.
VARCHAR_LIMITS = {
    "sellers": {"seller_id": 20, "name": 200, "country": 100},
    "products": {"product_id": 20, "name": 200, "category": 100},
    "orders": {"order_id": 40, "seller_id": 20, "customer_id": 20, "product_id": 20, "status": 20},
}
# ---------------------------------------------------------------------------

MONEY = T.DecimalType(12, 2)
REVENUE = T.DecimalType(14, 2)
PRICE = T.DecimalType(10, 2)
DROP_PCT = T.DecimalType(6, 2)


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SELLERS = _s(("seller_id", T.StringType()), ("name", T.StringType()),
             ("country", T.StringType()), ("joined_date", T.DateType()))
PRODUCTS = _s(("product_id", T.StringType()), ("name", T.StringType()),
              ("category", T.StringType()), ("base_price", PRICE))
CUSTOMERS = _s(("customer_id", T.StringType()), ("email", T.StringType()),
               ("city", T.StringType()), ("signup_date", T.DateType()))
ORDERS = _s(("order_id", T.StringType()), ("seller_id", T.StringType()),
            ("customer_id", T.StringType()), ("product_id", T.StringType()),
            ("dt", T.DateType()), ("quantity", T.IntegerType()),
            ("total_amount", MONEY), ("status", T.StringType()))
DIM_DATE = _s(("dt", T.DateType()), ("year", T.IntegerType()),
              ("month", T.IntegerType()), ("day_of_week", T.IntegerType()))
TOP_SELLERS = _s(("dt", T.DateType()), ("seller_id", T.StringType()), ("seller_name", T.StringType()),
                 ("revenue", REVENUE), ("nb_orders", T.IntegerType()))
DAILY_REVENUE = _s(("dt", T.DateType()), ("revenue", REVENUE), ("nb_orders", T.IntegerType()))
CATEGORY_BREAKDOWN = _s(("dt", T.DateType()), ("category", T.StringType()),
                        ("revenue", REVENUE), ("nb_orders", T.IntegerType()))
CUSTOMER_ACTIVITY = _s(("dt", T.DateType()), ("active_customers", T.IntegerType()),
                       ("dormant_customers", T.IntegerType()))
ANOMALIES = _s(("dt", T.DateType()), ("seller_id", T.StringType()), ("seller_name", T.StringType()),
               ("revenue", REVENUE), ("moving_avg_7d", REVENUE), ("drop_pct", DROP_PCT))

# As stored: a generated id and the time of the first detection.
STORED_ANOMALIES = T.StructType([T.StructField("id", T.LongType()), *ANOMALIES.fields, T.StructField("detected_at", T.TimestampType())])
# Rejected records by date of their folder, and what replaces them.
REJECTS = _s(("dt", T.DateType()), ("entity", T.StringType()), ("raw", T.StringType()),
             ("reject_reason", T.StringType()), ("source_file", T.StringType()))
REPAIRS = _s(("dt", T.DateType()), ("entity", T.StringType()), ("raw", T.StringType()), ("record", T.StringType()))
# Key index of staging.orders: an order id is held by ``dt`` while ``stamp`` is that date's.
ORDER_KEYS = _s(("order_id", T.StringType()), ("dt", T.DateType()), ("stamp", T.LongType()))
# State of customer activity.  ``ckey`` is never null (a null customer id has one of its own).
CUSTOMER_DAYS = _s(("dt", T.DateType()), ("ckey", T.StringType()))
CUSTOMER_SPAN = _s(("ckey", T.StringType()), ("first_dt", T.DateType()), ("last_dt", T.DateType()))
ACTIVITY_DELTAS = _s(("at", T.DateType()), ("seen", T.LongType()), ("act", T.LongType()))

ORDER_COLUMNS = [f.name for f in ORDERS.fields]

# Primary keys of every table (checked by operators.quality.check_primary_key).
PRIMARY_KEYS = {
    "sellers": ["seller_id"], "products": ["product_id"], "customers": ["customer_id"],
    "orders": ["order_id"], "dim_seller": ["seller_id"], "dim_product": ["product_id"],
    "dim_customer": ["customer_id"], "dim_date": ["dt"], "fact_orders": ["order_id"],
    "top_sellers": ["dt", "seller_id"], "daily_revenue": ["dt"],
    "category_breakdown": ["dt", "category"], "customer_activity": ["dt"],
    "anomalies": ["dt", "seller_id"],
}

# Foreign keys of the fact: column -> (dimension, key).
FACT_FOREIGN_KEYS = {
    "seller_id": ("dim_seller", "seller_id"),
    "customer_id": ("dim_customer", "customer_id"),
    "product_id": ("dim_product", "product_id"),
    "dt": ("dim_date", "dt"),
}
