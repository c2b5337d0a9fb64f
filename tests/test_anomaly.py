"""Anomaly detector edge cases (FIXTURES §4) in both forms."""

import datetime as dt
from decimal import Decimal

from souk import schemas as S
from souk.operators import anomaly

D0 = dt.date(2024, 1, 10)


def _fact(spark, rows):
    """rows: (seller_id, date, amount, status)."""
    data = [(f"o{i}", s, "c1", "p1", d, 1, Decimal(str(a)), st) for i, (s, d, a, st) in enumerate(rows)]
    return spark.createDataFrame(data, S.ORDERS)


def _sellers(spark):
    return spark.createDataFrame([("s1", "Seller 1", "FR", None)], S.SELLERS)


def _both(spark, rows, ds=D0):
    fact = _fact(spark, rows)
    one = [tuple(r) for r in anomaly.detect_anomalies(fact, _sellers(spark), ds).collect()]
    allf = [tuple(r) for r in anomaly.detect_anomalies_all(fact, _sellers(spark)).collect() if r["dt"] == ds]
    assert sorted(one) == sorted(allf)
    return one


def _week(amount_today):
    rows = [("s1", D0 - dt.timedelta(days=k), 100, "completed") for k in range(1, 8)]
    return rows + [("s1", D0, amount_today, "completed")]


def test_exactly_30_pct_not_flagged(spark):
    assert _both(spark, _week(70)) == []


def test_just_over_30_pct_flagged(spark):
    out = _both(spark, _week(69.99))
    assert len(out) == 1
    r = out[0]
    assert r[3] == Decimal("69.99") and r[4] == Decimal("100.00") and r[5] == Decimal("30.01")


def test_one_prior_day_is_enough(spark):
    out = _both(spark, [("s1", D0 - dt.timedelta(days=3), 200, "completed"), ("s1", D0, 50, "completed")])
    assert out[0][4] == Decimal("200.00") and out[0][5] == Decimal("75.00")


def test_prior_day_eight_days_ago_only(spark):
    assert _both(spark, [("s1", D0 - dt.timedelta(days=8), 200, "completed"), ("s1", D0, 50, "completed")]) == []


def test_no_valid_order_today(spark):
    rows = _week(10)[:-1] + [("s1", D0, 10, "cancelled")]
    assert _both(spark, rows) == []


def test_cancelled_and_null_status_excluded_from_average(spark):
    rows = _week(60) + [("s1", D0 - dt.timedelta(days=1), 1000, "cancelled"),
                        ("s1", D0 - dt.timedelta(days=2), 1000, None)]
    out = _both(spark, rows)
    assert out[0][4] == Decimal("100.00") and out[0][5] == Decimal("40.00")


def test_day_gaps_use_calendar_days(spark):
    # ROWS 7 PRECEDING would reach back 10 days here; the window is 7 calendar days.
    rows = [("s1", D0 - dt.timedelta(days=10), 1000, "completed"),
            ("s1", D0 - dt.timedelta(days=2), 100, "completed"), ("s1", D0, 50, "completed")]
    out = _both(spark, rows)
    assert out[0][4] == Decimal("100.00") and out[0][5] == Decimal("50.00")


def test_alert_rows(spark):
    found = anomaly.detect_anomalies_all(_fact(spark, _week(10)), _sellers(spark))
    rows = anomaly.alert_events(found).collect()
    assert [(r["event"], r["dt"], r["n_anomalies"]) for r in rows] == [("anomaly_detected", D0, 1)]


def test_ratios_are_exact_and_rounded_half_away_from_zero(spark):
    from decimal import ROUND_HALF_UP

    from pyspark.sql import functions as F

    from souk.functions import money
    pairs = [(a, b) for a in (0, 1, -1, 5, -5, 10**12 + 5, -(10**12 + 5), 3 * 10**14) for b in (1, -1, 2, 3, -7, 8, 2000, 10**9 + 7, 0)]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b in pairs], "a decimal(38,0), b decimal(38,0)").coalesce(1)
    ratio = df.select("a", "b", money.ratio_half_up(F.col("a"), F.col("b"), 2, 20).alias("q"))
    plan = ratio._jdf.queryExecution().optimizedPlan().toString()
    assert "pmod" not in plan and " / " not in plan                     # a remainder and a decimal quotient
    for r in ratio.collect():
        want = None if r.b == 0 else (r.a / r.b).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert r.q == want
