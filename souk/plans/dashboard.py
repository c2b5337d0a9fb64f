"""Dashboard reads (L1-L7): points and short ranges of the published tables.

Every function takes the warehouse and a date (default: the latest date of the
table) and opens only the files that hold the dates it shows; none reads the
fact or the raw data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from souk import schemas as S
from souk.functions import active_ratio
from souk.operators.sinks import sequential_id
from souk.plans.pipeline import Warehouse, latest_date_of, read_table

TREND_DAYS = 7


def dates(spark: SparkSession, wh: Warehouse) -> list[str]:
    """The dates that can be chosen, newest first (from the commit log)."""
    from souk.plans.pipeline import loaded_dates
    return loaded_dates(spark, wh, "analytics", "daily_revenue")[::-1]


def _day(spark: SparkSession, wh: Warehouse, table: str, ds=None) -> DataFrame:
    return read_table(spark, wh, "analytics", table, ds or _shown(spark, wh))


def _shown(spark: SparkSession, wh: Warehouse) -> str:
    return latest_date_of(spark, wh, "analytics", "daily_revenue")


def _rank(df: DataFrame, *order) -> DataFrame:
    """rank_no over a total order; for results of a few rows."""
    return df.withColumn("rank_no", F.row_number().over(Window.orderBy(*order)).cast("int"))


def kpi_day(spark: SparkSession, wh: Warehouse, ds=None) -> DataFrame:
    """L1: revenue and orders of the date."""
    return _day(spark, wh, "daily_revenue", ds)


def kpi_anomaly_count(spark: SparkSession, wh: Warehouse, ds=None) -> DataFrame:
    """L2: number of anomalies of the date (0 if none)."""
    ds = ds or _shown(spark, wh)
    return _day(spark, wh, "anomalies", ds).agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(
        F.lit(str(ds)).cast("date").alias("dt"), "n")


def revenue_trend(spark: SparkSession, wh: Warehouse, ds=None, days: int = TREND_DAYS) -> DataFrame:
    """L3: revenue of the date and the days before, in order."""
    end = _dt.date.fromisoformat(str(ds or _shown(spark, wh)))
    week = read_table(spark, wh, "analytics", "daily_revenue", dates=[end - _dt.timedelta(days=k) for k in range(days)])
    return _rank(week.select("dt", "revenue"), "dt")


def top_sellers(spark: SparkSession, wh: Warehouse, ds=None, n: int = S.TOP_N) -> DataFrame:
    """L4: the ``n`` sellers of the date with the most revenue."""
    best = _day(spark, wh, "top_sellers", ds).orderBy(F.desc_nulls_first("revenue"), "seller_id").limit(n)
    return _rank(best, F.desc_nulls_first("revenue"), "seller_id").select("rank_no", "seller_id", "seller_name", "revenue", "nb_orders")


def categories_ranked(spark: SparkSession, wh: Warehouse, ds=None) -> DataFrame:
    """Revenue of the date by category, greatest first."""
    return _rank(_day(spark, wh, "category_breakdown", ds).select("category", "revenue"), F.desc_nulls_first("revenue"), "category")


def category_domain(spark: SparkSession, wh: Warehouse, ds=None) -> DataFrame:
    """The categories of the chart, in order."""
    return _rank(_day(spark, wh, "category_breakdown", ds).select("category").distinct(), "category")


def active_share(spark: SparkSession, wh: Warehouse, dates=None) -> DataFrame:
    """Active and dormant customers with the active share, for ``dates`` or all."""
    act = read_table(spark, wh, "analytics", "customer_activity", dates=dates)
    return act.select("dt", "active_customers", "dormant_customers",
                      active_ratio(F.col("active_customers"), F.col("dormant_customers")).alias("active_ratio"))


def anomalies_ranked(spark: SparkSession, wh: Warehouse, ds=None) -> DataFrame:
    """Anomalies of the date, the largest drop first.  They grow with the
    number of sellers, so they are ranked in parallel."""
    day = _day(spark, wh, "anomalies", ds).select("seller_name", "seller_id", "revenue", "moving_avg_7d", "drop_pct")
    ranked = sequential_id(day, [F.desc_nulls_first("drop_pct"), F.asc("seller_id")], "rank_no")
    return ranked.withColumn("rank_no", F.col("rank_no").cast("int"))
