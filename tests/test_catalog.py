"""Catalog keys against their DuckDB statements on the smallest fixture."""

import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
# Keys that only read and compute (writers are covered by the other tests and the oracle script).
KEYS = ["anomalies_all", "anomalies", "top_sellers_all", "top_sellers", "daily_revenue", "daily_revenue_all",
        "daily_revenue_zero_filled", "category_breakdown_all", "customer_activity", "customer_activity_all",
        "moving_avg_7d", "drop_pct", "dq_report", "dq_rule_runner", "check_primary_key", "dedup_orders",
        "check_foreign_keys", "check_domains", "build_dim_customer", "build_dim_date", "top_10_sellers",
        "anomalies_ranked", "kpi_day", "kpi_anomaly_count", "revenue_trend_7d", "param_query",
        "anomalies_with_id", "upsert_dim_seller", "alert_events", "active_ratio", "dim_category"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("nation", "supplier", "part", "customer", "orders", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, Decimal):
            return str(v.normalize())
        if isinstance(v, float):
            return round(v, 9)
        return v if v is None or isinstance(v, (int, bool)) else str(v)
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, orows)


def test_every_warehouse_key_has_oracle():
    from souk.plans.catalog import QUERIES
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["dt", "seller_id", "seller_name", "revenue", "moving_avg_7d", "drop_pct"]
    assert df.count() == 698
