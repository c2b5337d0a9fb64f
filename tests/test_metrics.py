"""Daily metrics: activity window bounds, zero rows, all-dates = per-date."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from souk import schemas as S
from souk.operators import metrics

D0 = dt.date(2024, 3, 31)


def _fact(spark, rows):
    data = [(f"o{i}", "s1", c, "p1", d, 1, Decimal(a), st) for i, (c, d, a, st) in enumerate(rows)]
    return spark.createDataFrame(data, S.ORDERS)


def test_activity_bounds(spark):
    rows = [("c30", D0 - dt.timedelta(days=30), "1", "cancelled"),   # exactly 30 days: active
            ("c31", D0 - dt.timedelta(days=31), "1", "completed"),   # 31 days: dormant
            ("cnow", D0, "1", "pending")]
    r = metrics.customer_activity(_fact(spark, rows), D0).collect()[0]
    assert (r["active_customers"], r["dormant_customers"]) == (2, 1)


def test_activity_all_equals_per_date(spark):
    import random
    rnd = random.Random(7)
    rows = [(f"c{rnd.randint(1, 12)}", D0 - dt.timedelta(days=rnd.randint(0, 120)), "1", "completed")
            for _ in range(200)]
    fact = _fact(spark, rows)
    allf = {r["dt"]: (r["active_customers"], r["dormant_customers"])
            for r in metrics.customer_activity_all(fact).collect()}
    for d in sorted({r[1] for r in rows})[::9]:
        one = metrics.customer_activity(fact, d).collect()[0]
        assert allf[d] == (one["active_customers"], one["dormant_customers"])


def test_zero_row_for_day_without_valid_order(spark):
    fact = _fact(spark, [("c1", D0, "5", "cancelled"), ("c1", D0 - dt.timedelta(days=1), "7.25", "completed")])
    one = metrics.daily_revenue(fact, D0).collect()[0]
    assert (one["revenue"], one["nb_orders"]) == (Decimal("0.00"), 0)
    allf = {r["dt"]: (r["revenue"], r["nb_orders"]) for r in metrics.daily_revenue_zero_filled(fact).collect()}
    assert allf == {D0: (Decimal("0.00"), 0), D0 - dt.timedelta(days=1): (Decimal("7.25"), 1)}


def test_null_status_not_revenue(spark):
    fact = _fact(spark, [("c1", D0, "5", None), ("c1", D0, "2", "refunded")])
    r = metrics.daily_revenue_all(fact).collect()[0]
    assert (r["revenue"], r["nb_orders"]) == (Decimal("2.00"), 1)


def test_category_null_is_a_group(spark):
    fact = _fact(spark, [("c1", D0, "5", "completed")])
    products = spark.createDataFrame([("p1", "x", None, None)], S.PRODUCTS)
    r = metrics.category_breakdown(fact, products).collect()[0]
    assert r["category"] is None and r["revenue"] == Decimal("5.00")


def test_sum_invariants(spark):
    from souk.sources.fixtures import Fixture
    fx = Fixture(spark, "/root/testdata/sf0.001")
    fact = fx.fact
    total = metrics.daily_revenue_all(fact).agg(F.sum("revenue")).first()[0]
    sellers = metrics.top_sellers(fact, fx.sellers).agg(F.sum("revenue")).first()[0]
    cats = metrics.category_breakdown(fact, fx.products).agg(F.sum("revenue")).first()[0]
    assert total == sellers == cats
