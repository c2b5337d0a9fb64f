"""Hot keys: one seller / one customer holding a third of all orders."""

from decimal import Decimal

from pyspark.sql import functions as F

from souk.operators import anomaly, metrics
from souk.sources.fixtures import Fixture

SF = "/root/testdata/sf0.001"


def _skewed(spark):
    fx = Fixture(spark, SF)
    hot = F.abs(F.hash("order_id")) % 3 == 0
    fact = (fx.fact.withColumn("seller_id", F.when(hot, F.lit("1")).otherwise(F.col("seller_id")))
                   .withColumn("customer_id", F.when(hot, F.lit("7")).otherwise(F.col("customer_id"))))
    return fx, fact


def test_hot_seller_top_sellers_and_daily_match_brute_force(spark):
    fx, fact = _skewed(spark)
    pdf = fact.toPandas()
    assert (pdf.seller_id == "1").mean() > 0.3
    valid = pdf[pdf.status != "cancelled"]
    want = valid.groupby(["dt", "seller_id"]).total_amount.agg(["sum", "count"])
    got = {(r["dt"], r["seller_id"]): (r["revenue"], r["nb_orders"])
           for r in metrics.top_sellers(fact, fx.sellers).collect()}
    assert len(got) == len(want)
    for (d, s), row in want.iterrows():
        assert got[(d, s)] == (Decimal(row["sum"]).quantize(Decimal("0.01")), row["count"])


def test_hot_seller_anomalies_all_equal_one_date_form(spark):
    fx, fact = _skewed(spark)
    allf = anomaly.detect_anomalies_all(fact, fx.sellers)
    days = [r[0] for r in allf.where(F.col("seller_id") == "1").select("dt").distinct().limit(5).collect()]
    assert days
    for d in days:
        one = sorted(tuple(r) for r in anomaly.detect_anomalies(fact, fx.sellers, d).collect())
        assert one == sorted(tuple(r) for r in allf.where(F.col("dt") == d).collect())


def test_hot_customer_activity_all_equals_per_date(spark):
    _, fact = _skewed(spark)
    allf = {r["dt"]: (r["active_customers"], r["dormant_customers"])
            for r in metrics.customer_activity_all(fact).collect()}
    for d in sorted(allf)[::97]:
        r = metrics.customer_activity(fact, d).collect()[0]
        assert allf[d] == (r["active_customers"], r["dormant_customers"])
