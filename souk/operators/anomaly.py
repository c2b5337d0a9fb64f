"""Seller revenue anomalies.

A seller is flagged on a day when it has valid revenue that day and the
revenue is more than ``threshold`` percent below the average of its daily
revenue over the 7 previous calendar days (days without sales are left
out of the average; one prior day is enough).

All-dates form: one aggregate per (seller, day), then a RANGE window of
-7..-1 days over ``unix_date(dt)`` per seller.  The window partition of a
seller holds at most one row per calendar day, whatever its order volume.
One-date form: the same numbers from conditional aggregates over
[ds - 7, ds], no window.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk import schemas as S
from souk.functions.dates import in_dates
from souk.functions import drop_pct, is_drop_anomaly, moving_average
from souk.operators.joins import join_dim
from souk.operators.metrics import as_date, seller_daily_revenue

_OUT = ["dt", "seller_id", "seller_name", "revenue", "moving_avg_7d", "drop_pct"]


def with_moving_window(daily: DataFrame, days: int = S.MOVING_AVG_DAYS) -> DataFrame:
    """adds the sum ``win_sum`` and count ``win_n`` of revenue over [dt - days, dt - 1]."""
    w = Window.partitionBy("seller_id").orderBy("_day").rangeBetween(-days, -1)
    return (daily.withColumn("_day", F.unix_date("dt"))      # one column: both sums share one Window
                 .withColumns({"win_sum": F.sum("revenue").over(w), "win_n": F.count("revenue").over(w)}).drop("_day"))


def moving_avg_7d(fact: DataFrame, days: int = S.MOVING_AVG_DAYS) -> DataFrame:
    """F1 as a table: every seller-day with its (rounded) moving average."""
    win = with_moving_window(seller_daily_revenue(fact), days)
    return win.select("seller_id", "dt", F.col("revenue").cast(S.REVENUE).alias("revenue"),
                      moving_average(F.col("win_sum"), F.col("win_n")).alias("moving_avg_7d"),
                      F.col("win_n").cast("int").alias("days_in_window"))


def _flag_and_name(win: DataFrame, dim_seller: DataFrame, threshold) -> DataFrame:
    flagged = win.where(is_drop_anomaly(F.col("win_sum"), F.col("win_n"), F.col("revenue"), threshold))
    names = dim_seller.select("seller_id", F.col("name").alias("seller_name"))
    return join_dim(flagged, names, "seller_id").select(
        "dt", "seller_id", "seller_name",
        F.col("revenue").cast(S.REVENUE).alias("revenue"),
        moving_average(F.col("win_sum"), F.col("win_n")).alias("moving_avg_7d"),
        drop_pct(F.col("win_sum"), F.col("win_n"), F.col("revenue")).alias("drop_pct"))


def detect_anomalies_all(fact: DataFrame, dim_seller: DataFrame,
                         threshold=S.ANOMALY_THRESHOLD_PCT, days: int = S.MOVING_AVG_DAYS, dates=None) -> DataFrame:
    """K4 for every date at once (backfill form), or for a set of ``dates``:
    then only those and the ``days`` before each are read from the fact."""
    if dates is not None:
        wanted = {_dt.date.fromisoformat(str(d)) for d in dates}
        read = {d - _dt.timedelta(days=k) for d in wanted for k in range(days + 1)}
        fact = fact.where(in_dates("dt", read))
    win = with_moving_window(seller_daily_revenue(fact), days)
    if dates is not None:
        win = win.where(in_dates("dt", wanted))
    return _flag_and_name(win, dim_seller, threshold)


def detect_anomalies(fact: DataFrame, dim_seller: DataFrame, ds,
                     threshold=S.ANOMALY_THRESHOLD_PCT, days: int = S.MOVING_AVG_DAYS) -> DataFrame:
    """K4 for one date ``ds`` (a date, a string or a scalar Column)."""
    day = as_date(ds)
    daily = seller_daily_revenue(fact, day, days)
    prior = F.col("dt") < day
    per_seller = daily.groupBy("seller_id").agg(
        F.sum(F.when(prior, F.col("revenue"))).alias("win_sum"),
        F.count_if(prior).alias("win_n"),
        F.sum(F.when(~prior, F.col("revenue"))).alias("revenue"),
        F.count_if(~prior).alias("has_today"))
    win = per_seller.where(F.col("has_today") > 0).withColumn("dt", day)
    return _flag_and_name(win, dim_seller, threshold)


def alert_events(anomalies: DataFrame) -> DataFrame:
    """K5: one alert row per analysed date with at least one anomaly."""
    return anomalies.groupBy("dt").agg(F.count(F.lit(1)).cast("int").alias("n_anomalies")).select(
        F.lit(S.ALERT_EVENT).alias("event"), "dt", "n_anomalies")
