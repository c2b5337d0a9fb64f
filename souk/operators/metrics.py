"""Daily metrics (E3-E9) in a one-date form and an all-dates form.

All-dates forms never loop over dates: they group by ``dt`` in one job.
Revenue is summed as decimal (never double) and stored as NUMERIC(14,2);
counts are stored as INT.  Aggregations run before any join with a
dimension, so the shuffle carries at most one row per (date, key) and a
hot seller / product / customer is reduced by the map-side partial
aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk import schemas as S
from souk.functions import days_before, not_cancelled
from souk.operators.joins import join_dim


def as_date(ds) -> Column:
    """A date parameter: a Python date/str literal or a (scalar) Column."""
    return ds if isinstance(ds, Column) else F.lit(str(ds)).cast("date")


def latest_date(df: DataFrame) -> Column:
    """``SELECT MAX(dt)`` as a lazy scalar subquery."""
    return df.select(F.max("dt")).scalar()


def valid_orders(fact: DataFrame, ds=None) -> DataFrame:
    """C3 (+ A4 when ``ds`` is given): orders that count as revenue."""
    out = fact.where(not_cancelled("status"))
    return out if ds is None else out.where(F.col("dt") == as_date(ds))


def _revenue_aggs() -> list[Column]:
    return [F.sum("total_amount").cast(S.REVENUE).alias("revenue"),
            F.count(F.lit(1)).cast("int").alias("nb_orders")]


def top_sellers(fact: DataFrame, dim_seller: DataFrame, ds=None) -> DataFrame:
    """Revenue and order count per seller per day (all sellers kept)."""
    per_seller = valid_orders(fact, ds).groupBy("dt", "seller_id").agg(*_revenue_aggs())
    names = dim_seller.select("seller_id", F.col("name").alias("seller_name"))
    return join_dim(per_seller, names, "seller_id").select(
        "dt", "seller_id", "seller_name", "revenue", "nb_orders")


def daily_revenue_all(fact: DataFrame) -> DataFrame:
    """Revenue per day, days with at least one valid order."""
    return valid_orders(fact).groupBy("dt").agg(*_revenue_aggs())


def daily_revenue_of(fact: DataFrame, days: DataFrame) -> DataFrame:
    """E4 + E5 for the dates of ``days`` (column ``dt``): each has a row,
    (0, 0) on a day without a valid order or without any order."""
    return (days.select("dt").join(daily_revenue_all(fact), "dt", "left")
            .select("dt", F.coalesce("revenue", F.lit(0)).cast(S.REVENUE).alias("revenue"),
                    F.coalesce("nb_orders", F.lit(0)).alias("nb_orders")))


def daily_revenue_zero_filled(fact: DataFrame) -> DataFrame:
    """E4 + E5 for every date of the fact: a day without a valid order gets (0, 0).

    One aggregation over all orders with conditional sums: the date spine
    is the group set itself, so no spine join is needed.
    """
    valid = not_cancelled("status")
    return fact.groupBy("dt").agg(
        F.coalesce(F.sum(F.when(valid, F.col("total_amount"))), F.lit(0)).cast(S.REVENUE).alias("revenue"),
        F.count_if(F.coalesce(valid, F.lit(False))).cast("int").alias("nb_orders"))


def daily_revenue(fact: DataFrame, ds) -> DataFrame:
    """E4 + E5 for one date: always exactly one row."""
    day = as_date(ds)
    valid = valid_orders(fact, day)
    return valid.agg(
        F.coalesce(F.sum("total_amount"), F.lit(0)).cast(S.REVENUE).alias("revenue"),
        F.count(F.lit(1)).cast("int").alias("nb_orders"),
    ).select(day.alias("dt"), "revenue", "nb_orders")


def category_breakdown(fact: DataFrame, dim_product: DataFrame, ds=None) -> DataFrame:
    """Revenue per category per day; a NULL category is a group.

    One plan for any size: revenue per (dt, product_id) first, so the join
    carries one row per product and day, then rolled up by category.
    """
    per_product = valid_orders(fact, ds).groupBy("dt", "product_id").agg(
        F.sum("total_amount").alias("rev"), F.count(F.lit(1)).alias("n"))
    rows = join_dim(per_product, dim_product.select("product_id", "category"), "product_id")
    return rows.groupBy("dt", "category").agg(
        F.sum("rev").cast(S.REVENUE).alias("revenue"), F.sum("n").cast("int").alias("nb_orders"))


def customer_last_order(fact: DataFrame, ds) -> DataFrame:
    """Last order date per customer up to ``ds`` (any status)."""
    return (fact.where(F.col("dt") <= as_date(ds)).groupBy("customer_id")
            .agg(F.max("dt").alias("last_order_dt")))


def customer_activity(fact: DataFrame, ds, window_days: int = S.ACTIVE_WINDOW_DAYS) -> DataFrame:
    """E8 for one date: customers active in [ds - 30d, ds] vs seen before only."""
    day = as_date(ds)
    bound = days_before(day, window_days)
    last = customer_last_order(fact, day)
    return last.agg(
        F.count_if(F.col("last_order_dt") >= bound).cast("int").alias("active_customers"),
        F.count_if(F.col("last_order_dt") < bound).cast("int").alias("dormant_customers"),
    ).select(day.alias("dt"), "active_customers", "dormant_customers")


def customer_activity_all(fact: DataFrame, window_days: int = S.ACTIVE_WINDOW_DAYS,
                          dates: DataFrame | None = None) -> DataFrame:
    """E8 for every date of the fact, or of ``dates`` (column ``dt``), in one
    job (no dates x customers product).

    Per customer, distinct order days with the next order day ``nx``.  Each
    day emits deltas: first day (+1 seen, +1 active); when no order follows
    within ``window_days``: (day + window + 1, -1 active) and, if there is a
    later order, (nx, +1 active).  Deltas are summed per date and
    accumulated over the calendar; the running window holds one row per
    calendar day, a bound that does not grow with the order volume.
    """
    days = fact.where(F.col("dt").isNotNull()).select("customer_id", "dt").distinct()
    w = Window.partitionBy("customer_id").orderBy("dt")
    d = (days.withColumn("nx", F.lead("dt").over(w))
             .withColumn("is_first", F.lag("dt").over(w).isNull()))
    gap = F.col("nx").isNull() | (F.datediff("nx", "dt") > window_days)
    ev = F.struct
    events = d.select(F.explode(F.array(
        F.when(F.col("is_first"), ev(F.col("dt").alias("at"), F.lit(1).alias("seen"), F.lit(1).alias("act"))),
        F.when(gap, ev(F.date_add("dt", window_days + 1).alias("at"), F.lit(0).alias("seen"), F.lit(-1).alias("act"))),
        F.when(gap & F.col("nx").isNotNull(), ev(F.col("nx").alias("at"), F.lit(0).alias("seen"), F.lit(1).alias("act"))),
    )).alias("e")).where(F.col("e").isNotNull()).select("e.*")
    deltas = events.groupBy("at").agg(F.sum("seen").alias("seen"), F.sum("act").alias("act"),
                                      F.lit(False).alias("spine"))
    spine = (days if dates is None else dates).groupBy(F.col("dt").alias("at")).agg(
        F.lit(0).cast("bigint").alias("seen"), F.lit(0).cast("bigint").alias("act"), F.lit(True).alias("spine"))
    per_day = deltas.unionByName(spine).groupBy("at").agg(
        F.sum("seen").alias("seen"), F.sum("act").alias("act"), F.max("spine").alias("spine"))
    running = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    acc = (per_day.withColumn("seen_total", F.sum("seen").over(running))
                  .withColumn("active_total", F.sum("act").over(running)))
    return acc.where("spine").select(
        F.col("at").alias("dt"),
        F.col("active_total").cast("int").alias("active_customers"),
        (F.col("seen_total") - F.col("active_total")).cast("int").alias("dormant_customers"))


def seller_daily_revenue(fact: DataFrame, ds=None, lookback_days: int = S.MOVING_AVG_DAYS) -> DataFrame:
    """Valid revenue per (seller_id, dt); one date -> [ds - lookback, ds]."""
    valid = valid_orders(fact)
    if ds is not None:
        day = as_date(ds)
        valid = valid.where(F.col("dt").between(days_before(day, lookback_days), day))
    return valid.groupBy("seller_id", "dt").agg(F.sum("total_amount").alias("revenue"))
