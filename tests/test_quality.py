"""Rule runner (J1) and constraint checks."""

import pytest
from pyspark.sql import functions as F

from souk.operators import quality

ORDERS = "order_id string, seller_id string, dt date, total_amount decimal(12,2), status string"


def _orders(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame([(a, b, c, Decimal(d), e) for a, b, c, d, e in rows], ORDERS)


def _const_rule(name, value, **kw):
    return {"name": name, "sql": f"SELECT {value}", **kw}


def test_all_rules_pass(spark):
    res = quality.run_rules(spark, [_const_rule(n, 0) for n in ("a", "b", "c")])
    assert [r["passed"] for r in res] == [True, True, True]


def test_failure_raises_and_names_rule(spark):
    with pytest.raises(quality.DataQualityError, match=r"\[rule_b\] value=5"):
        quality.run_rules(spark, [_const_rule("rule_a", 0), _const_rule("rule_b", 5), _const_rule("rule_c", 0)])


def test_custom_comparison(spark):
    res = quality.run_rules(spark, [_const_rule("volume", 150, expected=100, comparison=">=")])
    assert res[0]["passed"] and res[0]["actual"] == 150


def test_fail_fast_runs_one_statement(spark):
    # The second rule's SQL is invalid: it must never be executed.
    rules = [_const_rule("first", 10), {"name": "second", "sql": "SELECT * FROM no_such_table"}]
    with pytest.raises(quality.DataQualityError, match="first"):
        quality.run_rules(spark, rules, fail_on_first_error=True)


def test_unknown_comparison_fails_before_sql(spark):
    with pytest.raises(KeyError):
        quality.run_rules(spark, [{"name": "x", "sql": "SELECT * FROM no_such_table", "comparison": "~"}])


def test_no_row_gives_none(spark):
    res = quality.run_rules(spark, [{"name": "empty", "sql": "SELECT 1 WHERE false", "comparison": "!="}])
    assert res[0]["actual"] is None and res[0]["passed"]


def test_builtin_rules_fused_equal_sql_rules(spark):
    o = _orders(spark, [
        (None, "1", None, 10, "completed"), (None, "1", None, 5, "pending"),
        ("a", "1", None, -1, None), ("a", "9", None, 3, "lost"), ("b", None, None, 0, "cancelled")])
    o = o.withColumn("dt", F.lit("2024-01-01").cast("date"))
    sellers = spark.createDataFrame([("1", "s")], "seller_id string, name string")
    fused = {r["name"]: r["actual"] for r in quality.order_rule_report(o, sellers).collect()}
    sql = {r["name"]: r["actual"] for r in quality.run_rules(
        spark, quality.order_rules(o, sellers, ds="2024-01-01"), raise_on_failure=False)}
    assert fused == sql
    # NULL order_id twice: not-null rule 2; both NULLs count as surplus, plus one copy of "a"
    assert fused["not_null_order_id"] == 2 and fused["no_duplicate_orders"] == 3
    # NULL status passes valid_status; NULL seller is an orphan
    assert fused["valid_status"] == 1 and fused["referential_seller"] == 2
    assert fused["positive_amount"] == 2
    with pytest.raises(quality.DataQualityError):
        quality.gate(quality.order_rule_report(o, sellers))


def test_primary_key_and_dedup(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5), (None, 7)], "k string, v int")
    bad = {r["k"]: r["n"] for r in quality.check_primary_key(df, ["k"]).collect()}
    assert bad == {"a": 2, None: 1}
    d = {r["k"]: r["v"] for r in quality.dedup(df, ["k"], ["v"]).collect()}
    assert d == {"a": 1, "b": 5, None: 7}


def test_foreign_keys_null_passes(spark):
    fact = spark.createDataFrame([("1",), ("2",), (None,)], "seller_id string")
    dim = spark.createDataFrame([("1",)], "seller_id string")
    out = quality.check_foreign_keys(fact, {"dim_seller": dim}, {"seller_id": ("dim_seller", "seller_id")})
    assert out.collect()[0]["n_orphans"] == 1


def test_domains(spark):
    df = spark.createDataFrame([("abcdef", "10000.00"), ("ab", "9999.99")], "name string, amt string")
    df = df.withColumn("amt", F.col("amt").cast("decimal(12,2)"))
    out = {r["rule"]: r["n"] for r in quality.check_domains(df, {"name": 3}, {"amt": (6, 2)}).collect()}
    assert out == {"name:varchar(3)": 1, "amt:numeric(6,2)": 1}
