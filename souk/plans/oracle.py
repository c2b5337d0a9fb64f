"""Reference SQL (DuckDB dialect) for every catalog key.

Each statement states, in plain SQL over the benchmark tables, the result
the matching Spark job must return.  Money is compared in exact decimals:
averages and percentage drops are computed in integer cents with half-up
rounding, the same rule the Spark side uses.
"""

from __future__ import annotations

# Shared CTEs; DuckDB only evaluates the ones a statement references.
BASE = """
sellers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, s_name AS name, n_name AS country,
         CAST(NULL AS DATE) AS joined_date
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS base_price
  FROM part),
customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(NULL AS VARCHAR) AS email,
         CAST(NULL AS VARCHAR) AS city, CAST(NULL AS DATE) AS signup_date
  FROM customer),
lines AS (
  SELECT l.*, o_custkey, o_orderdate,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity,
                                     l_returnflag, l_linestatus) AS rn
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey),
shaped AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
         CAST(l_suppkey AS VARCHAR) AS seller_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(o_orderdate AS DATE) AS dt,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS total_amount,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'refunded'
              WHEN l_returnflag = 'R' THEN 'cancelled'
              WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'pending'
              ELSE 'completed' END AS status,
         l_orderkey AS k, l_linenumber AS line_no, rn
  FROM lines),
raw_orders AS (
  SELECT order_id, seller_id, customer_id, product_id, dt, quantity, total_amount, status FROM shaped),
fact AS (
  SELECT order_id, seller_id, customer_id, product_id, dt, quantity, total_amount, status
  FROM shaped WHERE rn = 1),
faulty AS (
  SELECT CASE WHEN line_no = 7 AND k % 50 = 0 THEN NULL ELSE order_id END AS order_id,
         CASE WHEN k % 89 = 0 THEN 'none' WHEN k % 83 = 0 THEN NULL ELSE seller_id END AS seller_id,
         customer_id, product_id, dt, quantity,
         CAST(CASE WHEN k % 97 = 0 THEN -total_amount ELSE total_amount END AS DECIMAL(12,2)) AS total_amount,
         CASE WHEN k % 101 = 0 THEN 'lost' WHEN k % 103 = 0 THEN NULL ELSE status END AS status
  FROM shaped),
ds AS (SELECT MAX(dt) AS ds FROM fact),
valid AS (SELECT * FROM fact WHERE status <> 'cancelled'),
seller_day AS (
  SELECT seller_id, dt, SUM(total_amount) AS revenue FROM valid GROUP BY seller_id, dt),
seller_win AS (
  SELECT seller_id, dt, revenue,
         SUM(revenue) OVER w AS win_sum, COUNT(revenue) OVER w AS win_n
  FROM seller_day
  WINDOW w AS (PARTITION BY seller_id ORDER BY dt
               RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING)),
seller_win_c AS (
  SELECT seller_id, dt, revenue, win_sum, win_n,
         CAST(win_sum * 100 AS HUGEINT) AS s, CAST(revenue * 100 AS HUGEINT) AS c
  FROM seller_win),
anomalies_all AS (
  SELECT w.dt, w.seller_id, sl.name AS seller_name, CAST(w.revenue AS DECIMAL(14,2)) AS revenue,
         CAST(CAST((2 * s + win_n) // (2 * win_n) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(14,2)) AS moving_avg_7d,
         CAST(CAST((2 * 10000 * (s - win_n * c) + s) // (2 * s) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(6,2)) AS drop_pct
  FROM seller_win_c w JOIN sellers sl ON sl.seller_id = w.seller_id
  WHERE win_n > 0 AND s > 0 AND 100 * (s - win_n * c) > 30 * s),
top_sellers_all AS (
  SELECT f.dt, f.seller_id, s.name AS seller_name, CAST(SUM(f.total_amount) AS DECIMAL(14,2)) AS revenue,
         CAST(COUNT(*) AS INTEGER) AS nb_orders
  FROM valid f JOIN sellers s ON f.seller_id = s.seller_id
  GROUP BY f.dt, f.seller_id, s.name),
daily_all AS (
  SELECT dt, CAST(COALESCE(SUM(total_amount) FILTER (WHERE status <> 'cancelled'), 0) AS DECIMAL(14,2)) AS revenue,
         CAST(COUNT(*) FILTER (WHERE status <> 'cancelled') AS INTEGER) AS nb_orders
  FROM fact GROUP BY dt),
category_all AS (
  SELECT f.dt, p.category, CAST(SUM(f.total_amount) AS DECIMAL(14,2)) AS revenue,
         CAST(COUNT(*) AS INTEGER) AS nb_orders
  FROM valid f JOIN products p ON f.product_id = p.product_id
  GROUP BY f.dt, p.category),
fact_days AS (SELECT DISTINCT dt FROM fact),
activity_all AS (
  SELECT d.dt,
         CAST(COUNT(*) FILTER (WHERE lo.last_dt >= d.dt - 30) AS INTEGER) AS active_customers,
         CAST(COUNT(*) FILTER (WHERE lo.last_dt < d.dt - 30) AS INTEGER) AS dormant_customers
  FROM fact_days d, LATERAL (
    SELECT customer_id, MAX(dt) AS last_dt FROM fact WHERE fact.dt <= d.dt GROUP BY customer_id) lo
  GROUP BY d.dt),
dq AS (
  SELECT name, actual, CAST(0 AS BIGINT) AS expected, '==' AS comparison, actual = 0 AS passed FROM (
    SELECT 'not_null_order_id' AS name, CAST(COUNT(*) FILTER (WHERE order_id IS NULL) AS BIGINT) AS actual FROM faulty
    UNION ALL SELECT 'no_duplicate_orders', CAST(COUNT(*) - COUNT(DISTINCT order_id) AS BIGINT) FROM faulty
    UNION ALL SELECT 'positive_amount', CAST(COUNT(*) FILTER (WHERE total_amount <= 0) AS BIGINT) FROM faulty
    UNION ALL SELECT 'valid_status',
      CAST(COUNT(*) FILTER (WHERE status NOT IN ('completed','pending','cancelled','refunded')) AS BIGINT) FROM faulty
    UNION ALL SELECT 'referential_seller', CAST(COUNT(*) AS BIGINT)
      FROM faulty o LEFT JOIN sellers s ON o.seller_id = s.seller_id WHERE s.seller_id IS NULL)),
dim_date_rows AS (
  SELECT DISTINCT dt, CAST(EXTRACT(YEAR FROM dt) AS INTEGER) AS year, CAST(EXTRACT(MONTH FROM dt) AS INTEGER) AS month,
         CAST(EXTRACT(DOW FROM dt) AS INTEGER) AS day_of_week
  FROM fact)
"""


def q(body: str) -> str:
    """A statement over the shared CTEs."""
    return "WITH " + BASE.strip() + "\n" + body.strip()


ORACLE: dict[str, str] = {}


DS = "(SELECT ds FROM ds)"
STATUS_LIST = "('completed','pending','cancelled','refunded')"

_BODIES = {
    # A: sources
    "scan_raw_orders": "SELECT * FROM raw_orders",
    "scan_raw_sellers": "SELECT * FROM sellers",
    "scan_raw_products": "SELECT * FROM products",
    "raw_json_roundtrip": "SELECT * FROM fact",
    "scan_partition": f"SELECT * FROM daily_all WHERE dt = {DS}",
    "latest_partition": "SELECT MAX(dt) AS latest_dt FROM fact",
    # B: sinks
    "replace_partition_idempotent": "SELECT * FROM daily_all",
    "replace_partition_empty": f"SELECT * FROM daily_all WHERE dt < {DS}",
    "upsert_dim_seller": """
        SELECT * FROM sellers WHERE CAST(seller_id AS BIGINT) % 2 = 0
        UNION ALL
        SELECT seller_id, 'old' AS name, country, joined_date FROM sellers
        WHERE CAST(seller_id AS BIGINT) % 3 <> 0 AND CAST(seller_id AS BIGINT) % 2 <> 0""",
    "upsert_dim_product": """
        SELECT * FROM products WHERE CAST(product_id AS BIGINT) % 2 = 0
        UNION ALL
        SELECT product_id, 'old' AS name, category, base_price FROM products
        WHERE CAST(product_id AS BIGINT) % 3 <> 0 AND CAST(product_id AS BIGINT) % 2 <> 0""",
    "insert_absent_dim_date": """
        SELECT dt, CASE WHEN dt < DATE '1998-01-01' THEN -1 ELSE year END AS year, month, day_of_week
        FROM dim_date_rows""",
    "anomalies_with_id": "SELECT *, CAST(row_number() OVER (ORDER BY dt, seller_id) AS BIGINT) AS id FROM anomalies_all",
    "partition_row_count": f"SELECT {DS} AS dt, CAST(COUNT(*) AS BIGINT) AS n_rows FROM fact WHERE dt = {DS}",
    # C: projections / filters
    "stage_orders": """
        SELECT order_id, seller_id, customer_id, product_id, dt, quantity, total_amount, status
        FROM shaped WHERE k % 11 <> 0""",
    "stage_orders_rejects": """
        SELECT 'dt differs from folder' AS reject_reason, CAST(COUNT(*) AS BIGINT) AS n
        FROM shaped WHERE k % 11 = 0 GROUP BY 1""",
    "stage_sellers": "SELECT * FROM sellers",
    "stage_products": "SELECT * FROM products",
    "build_fact_orders": f"SELECT * FROM fact WHERE dt = {DS}",
    "filter_valid_orders": "SELECT * FROM valid",
    "filter_date_range": f"SELECT * FROM fact WHERE dt BETWEEN {DS} - 7 AND {DS}",
    "filter_invalid_status": f"SELECT * FROM faulty WHERE status NOT IN {STATUS_LIST}",
    "filter_null_keys": "SELECT * FROM faulty WHERE order_id IS NULL",
    "filter_non_positive_amount": "SELECT * FROM faulty WHERE total_amount <= 0",
    "param_query": f"""
        SELECT status, CAST(SUM(total_amount) AS DECIMAL(14,2)) AS revenue, CAST(COUNT(*) AS INTEGER) AS nb_orders
        FROM fact WHERE dt BETWEEN {DS} - 6 AND {DS} GROUP BY status""",
    # D: joins
    "join_fact_seller": """
        SELECT f.order_id, f.seller_id, s.name AS seller_name, f.dt, f.total_amount
        FROM fact f JOIN sellers s ON f.seller_id = s.seller_id""",
    "join_fact_product": """
        SELECT f.order_id, f.product_id, p.category, f.dt, f.total_amount
        FROM fact f JOIN products p ON f.product_id = p.product_id""",
    "anti_join_orphan_seller": """
        SELECT o.* FROM faulty o LEFT JOIN sellers s ON o.seller_id = s.seller_id WHERE s.seller_id IS NULL""",
    "build_dim_customer": """
        , cur AS (SELECT * FROM customers WHERE CAST(customer_id AS BIGINT) % 4 = 0)
        SELECT * FROM cur
        UNION ALL
        SELECT DISTINCT f.customer_id, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS DATE)
        FROM fact f LEFT JOIN cur d ON f.customer_id = d.customer_id
        WHERE d.customer_id IS NULL AND f.customer_id IS NOT NULL""",
    # E: aggregations
    "agg_duplicate_count": "SELECT CAST(COUNT(*) - COUNT(DISTINCT order_id) AS BIGINT) AS n_duplicates FROM raw_orders",
    "top_sellers": f"SELECT * FROM top_sellers_all WHERE dt = {DS}",
    "top_sellers_all": "SELECT * FROM top_sellers_all",
    "daily_revenue_all": """
        SELECT dt, CAST(SUM(total_amount) AS DECIMAL(14,2)) AS revenue, CAST(COUNT(*) AS INTEGER) AS nb_orders
        FROM valid GROUP BY dt""",
    "daily_revenue": f"""
        SELECT {DS} AS dt, CAST(COALESCE(SUM(total_amount), 0) AS DECIMAL(14,2)) AS revenue,
               CAST(COUNT(*) AS INTEGER) AS nb_orders
        FROM valid WHERE dt = {DS}""",
    "daily_revenue_zero_filled": "SELECT * FROM daily_all",
    "category_breakdown": f"SELECT * FROM category_all WHERE dt = {DS}",
    "category_breakdown_all": "SELECT * FROM category_all",
    "customer_last_order": f"""
        SELECT customer_id, MAX(dt) AS last_order_dt FROM fact WHERE dt <= {DS} GROUP BY customer_id""",
    "customer_activity": f"""
        , lo AS (SELECT customer_id, MAX(dt) AS last_dt FROM fact WHERE dt <= {DS} GROUP BY customer_id)
        SELECT {DS} AS dt,
               CAST(COUNT(*) FILTER (WHERE last_dt >= {DS} - 30) AS INTEGER) AS active_customers,
               CAST(COUNT(*) FILTER (WHERE last_dt < {DS} - 30) AS INTEGER) AS dormant_customers
        FROM lo""",
    "customer_activity_all": "SELECT * FROM activity_all",
    "seller_daily_revenue": "SELECT seller_id, dt, CAST(revenue AS DECIMAL(14,2)) AS revenue FROM seller_day",
    # F / I
    "moving_avg_7d": """
        SELECT seller_id, dt, CAST(revenue AS DECIMAL(14,2)) AS revenue,
               CASE WHEN win_n > 0 THEN
                 CAST(CAST(sign(s) * ((2 * abs(s) + win_n) // (2 * win_n)) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(14,2))
               END AS moving_avg_7d,
               CAST(win_n AS INTEGER) AS days_in_window
        FROM seller_win_c""",
    "build_dim_date": "SELECT * FROM dim_date_rows",
    "date_window_bounds": """
        SELECT DISTINCT dt, dt - 30 AS active_from, dt - 7 AS lookback_from, dt - 6 AS trend_from FROM fact""",
    "drop_pct": """
        SELECT seller_id, dt,
               CAST(CAST(sign(x) * ((2 * abs(x) + s) // (2 * s)) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS drop_pct
        FROM (SELECT seller_id, dt, s, 10000 * (s - win_n * c) AS x FROM seller_win_c WHERE win_sum > 0)""",
    "active_ratio": """
        SELECT dt, active_customers, dormant_customers,
               CAST(active_customers AS DOUBLE) / CAST(GREATEST(active_customers + dormant_customers, 1) AS DOUBLE)
                 AS active_ratio
        FROM activity_all""",
    # J: quality
    "dq_report": "SELECT * FROM dq",
    "dq_rule_runner": "SELECT * FROM dq",
    "check_primary_key": """
        SELECT order_id, CAST(COUNT(*) AS BIGINT) AS n FROM raw_orders
        GROUP BY order_id HAVING COUNT(*) > 1 OR order_id IS NULL""",
    "dedup_orders": """
        SELECT order_id, seller_id, customer_id, product_id, dt, quantity, total_amount, status FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id
                    ORDER BY product_id, seller_id, total_amount, quantity, status, customer_id, dt) AS rn
          FROM raw_orders) WHERE rn = 1""",
    "check_foreign_keys": """
        SELECT 'dim_seller' AS dim, 'seller_id' AS fk_column, CAST(COUNT(*) AS BIGINT) AS n_orphans
        FROM fact f LEFT JOIN (SELECT seller_id FROM sellers WHERE CAST(seller_id AS BIGINT) % 10 <> 0) d
          ON f.seller_id = d.seller_id WHERE f.seller_id IS NOT NULL AND d.seller_id IS NULL
        UNION ALL
        SELECT 'dim_customer', 'customer_id', CAST(COUNT(*) AS BIGINT)
        FROM fact f LEFT JOIN (SELECT customer_id FROM customers WHERE CAST(customer_id AS BIGINT) % 10 <> 0) d
          ON f.customer_id = d.customer_id WHERE f.customer_id IS NOT NULL AND d.customer_id IS NULL
        UNION ALL
        SELECT 'dim_product', 'product_id', CAST(COUNT(*) AS BIGINT)
        FROM fact f LEFT JOIN (SELECT product_id FROM products WHERE CAST(product_id AS BIGINT) % 10 <> 0) d
          ON f.product_id = d.product_id WHERE f.product_id IS NOT NULL AND d.product_id IS NULL
        UNION ALL
        SELECT 'dim_date', 'dt', CAST(COUNT(*) AS BIGINT)
        FROM fact f LEFT JOIN (SELECT dt FROM dim_date_rows WHERE dt >= DATE '1996-01-01') d
          ON f.dt = d.dt WHERE f.dt IS NOT NULL AND d.dt IS NULL""",
    "check_domains": """
        SELECT 'name:varchar(15)' AS rule, CAST(COUNT(*) FILTER (WHERE length(name) > 15) AS BIGINT) AS n FROM sellers
        UNION ALL
        SELECT 'total_amount:numeric(6,2)',
               CAST(COUNT(*) FILTER (WHERE total_amount IS NOT NULL
                                      AND TRY_CAST(total_amount AS DECIMAL(6,2)) IS NULL) AS BIGINT)
        FROM fact""",
    # K: pipelines
    "pipeline_ingest": "SELECT * FROM fact",
    "pipeline_star_fact": "SELECT * FROM fact",
    "pipeline_gate": """
        SELECT dt, CAST(COUNT(*) AS BIGINT) AS n_rows FROM raw_orders LEFT JOIN sellers s USING (seller_id) GROUP BY dt
        HAVING COUNT(*) = COUNT(DISTINCT order_id) AND COUNT(*) FILTER (WHERE total_amount <= 0) = 0
           AND COUNT(*) = COUNT(s.name) AND COUNT(*) = COUNT(CASE WHEN status IN ('completed', 'pending', 'cancelled', 'refunded') THEN 1 END)""",
    "pipeline_aggregate": """
        SELECT 'top_sellers' AS table_name, dt, seller_id AS key, revenue, nb_orders AS n FROM top_sellers_all
        UNION ALL SELECT 'daily_revenue', dt, NULL, revenue, nb_orders FROM daily_all
        UNION ALL SELECT 'category_breakdown', dt, category, revenue, nb_orders FROM category_all
        UNION ALL SELECT 'customer_activity', dt, 'active', NULL, active_customers FROM activity_all
        UNION ALL SELECT 'customer_activity', dt, 'dormant', NULL, dormant_customers FROM activity_all""",
    "anomalies": f"SELECT * FROM anomalies_all WHERE dt = {DS}",
    "anomalies_all": "SELECT * FROM anomalies_all",
    "alert_events": """
        SELECT 'anomaly_detected' AS event, dt, CAST(COUNT(*) AS INTEGER) AS n_anomalies
        FROM anomalies_all GROUP BY dt""",
    "rerun_idempotent": """
        SELECT 'orders' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows,
               CAST(SUM(total_amount) AS DECIMAL(18,2)) AS revenue FROM fact
        UNION ALL SELECT 'fact_orders', COUNT(*), CAST(SUM(total_amount) AS DECIMAL(18,2)) FROM fact
        UNION ALL SELECT 'top_sellers', COUNT(*), CAST(SUM(revenue) AS DECIMAL(18,2)) FROM top_sellers_all
        UNION ALL SELECT 'daily_revenue', COUNT(*), CAST(SUM(revenue) AS DECIMAL(18,2)) FROM daily_all
        UNION ALL SELECT 'category_breakdown', COUNT(*), CAST(SUM(revenue) AS DECIMAL(18,2)) FROM category_all
        UNION ALL SELECT 'customer_activity', COUNT(*), CAST(NULL AS DECIMAL(18,2)) FROM activity_all
        UNION ALL SELECT 'anomalies', COUNT(*), CAST(SUM(revenue) AS DECIMAL(18,2)) FROM anomalies_all""",
    "dim_category": """
        SELECT p.product_id, p.name, p.category, m.family
        FROM products p LEFT JOIN (VALUES ('ECONOMY', 'value'), ('LARGE', 'bulk'), ('MEDIUM', 'core'),
                                          ('PROMO', 'value'), ('SMALL', 'core'), ('STANDARD', 'core'))
          AS m(category, family) ON p.category = m.category""",
    # L: dashboard reads
    "kpi_day": "SELECT * FROM daily_all WHERE dt = (SELECT MAX(dt) FROM daily_all)",
    "kpi_anomaly_count": f"SELECT {DS} AS dt, CAST(COUNT(*) AS BIGINT) AS n FROM anomalies_all WHERE dt = {DS}",
    "revenue_trend_7d": """
        SELECT dt, revenue, CAST(row_number() OVER (ORDER BY dt) AS INTEGER) AS rank_no FROM daily_all
        WHERE dt BETWEEN (SELECT MAX(dt) FROM daily_all) - 6 AND (SELECT MAX(dt) FROM daily_all)""",
    "top_10_sellers": f"""
        SELECT CAST(row_number() OVER (ORDER BY revenue DESC NULLS FIRST, seller_id) AS INTEGER) AS rank_no,
               seller_id, seller_name, revenue, nb_orders
        FROM top_sellers_all WHERE dt = {DS}
        ORDER BY revenue DESC NULLS FIRST, seller_id LIMIT 10""",
    "category_ranked": f"""
        SELECT category, revenue,
               CAST(row_number() OVER (ORDER BY revenue DESC NULLS FIRST, category NULLS FIRST) AS INTEGER) AS rank_no
        FROM category_all WHERE dt = {DS}""",
    "category_domain": f"""
        SELECT category, CAST(row_number() OVER (ORDER BY category NULLS FIRST) AS INTEGER) AS rank_no
        FROM (SELECT DISTINCT category FROM category_all WHERE dt = {DS})""",
    "anomalies_ranked": f"""
        SELECT seller_name, seller_id, revenue, moving_avg_7d, drop_pct,
               CAST(row_number() OVER (ORDER BY drop_pct DESC NULLS FIRST, seller_id) AS INTEGER) AS rank_no
        FROM anomalies_all WHERE dt = {DS}""",
    # M: streaming
    "stream_ingest": "SELECT * FROM daily_all",
}
for _rule in ("not_null_order_id", "no_duplicate_orders", "positive_amount", "valid_status", "referential_seller"):
    _BODIES[f"dq_{_rule}"] = f"SELECT * FROM dq WHERE name = '{_rule}'"


def _statement(body: str) -> str:
    body = body.strip()
    if body.startswith(","):          # the body adds its own CTEs
        return "WITH " + BASE.strip() + body
    return q(body)


ORACLE.update({k: _statement(v) for k, v in _BODIES.items()})
