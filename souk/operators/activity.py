"""E7/E8 kept up to date: customer activity from stored state.

The state is three tables: the distinct (date, customer) pairs, every
customer's first and last order date, and per calendar day the change of the
number of customers ever seen and of active ones.  A day ``x`` of a customer
changes the active number by

* +1 at ``x`` if the customer has no order in the ``window`` days before, and
* -1 at ``x + window + 1`` if it has none in the ``window`` days after,

so what a run changes depends only on days within ``window`` of its dates, for
the customers that it touches, in whatever order dates arrive.  A run reads
these days and the touched customers' spans, never the whole fact; only where a
rerun takes away a customer's first or last day are its other days looked up.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from souk import schemas as S
from souk.functions.dates import in_dates
from souk.operators.store import Transaction
from souk.session import shared_dir

DAYS, SPANS, DELTAS, ACTIVITY = ("analytics/customer_days", "analytics/customer_spans",
                                 "analytics/activity_deltas", "analytics/customer_activity")


def customer_key(col: str = "customer_id") -> Column:
    """The customer as a key that is never null; no customer is one of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(col)), F.lit("")).alias("ckey")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _act_events(days: DataFrame, window: int) -> DataFrame:
    """``at, act`` per (sign, customer): where activity begins and ends."""
    w = Window.partitionBy("sign", "ckey").orderBy("dt")
    d = days.withColumns({"prev": F.lag("dt").over(w), "next": F.lead("dt").over(w)})
    starts = F.when(F.col("prev").isNull() | (F.datediff("dt", "prev") > window), F.struct(F.col("dt").alias("at"), F.col("sign").alias("act")))
    ends = F.when(F.col("next").isNull() | (F.datediff("next", "dt") > window),
                  F.struct(F.date_add("dt", window + 1).alias("at"), (-F.col("sign")).alias("act")))
    return d.select(F.inline(F.array_compact(F.array(starts, ends))))


def update(tx: Transaction, fact: DataFrame, dates: list[str], window: int = S.ACTIVE_WINDOW_DAYS) -> None:
    """Bring the state to ``fact`` (the orders of ``dates``, replacing what the
    state had of these dates) and publish the activity of ``dates`` and of the
    later dates that it changes."""
    spark = tx.spark
    held = set(tx.parts(DAYS))
    near = {str(_dt.date.fromisoformat(d) + _dt.timedelta(days=k)) for d in dates for k in range(-window, window + 1)} & held
    before = tx.read(DAYS, S.CUSTOMER_DAYS, near)
    mine = in_dates("dt", dates)
    tx.replace(DAYS, fact.where(mine).select("dt", customer_key()).distinct(), "dt", dates, S.CUSTOMER_DAYS, ["ckey"])
    new = tx.read(DAYS, S.CUSTOMER_DAYS, dates)                     # ``before`` still reads the old files
    if held.isdisjoint(map(str, dates)):                            # nothing is replaced: every pair is new
        changed = new.select("ckey", "dt", F.lit(1).cast("long").alias("s"))
    else:
        both = (before.where(mine).select("dt", "ckey", F.lit(-1).alias("s")).unionByName(new.select("dt", "ckey", F.lit(1).alias("s")))
                .groupBy("ckey", "dt").agg(F.sum("s").alias("s")).where("s <> 0"))
        changed = _stored(both, "activity-changed")                 # s: 1 a new day, -1 a day that is gone
    touched = changed.select("ckey").distinct()

    # days near the dates of the touched customers, as they were (sign -1) and as they are (+1)
    old_days = before.join(touched, "ckey", "left_semi").select("ckey", "dt")
    gone = changed.where("s < 0").select("ckey", "dt")
    now_days = old_days.join(gone, ["ckey", "dt"], "left_anti").unionByName(changed.where("s > 0").select("ckey", "dt"))
    versions = old_days.withColumn("sign", F.lit(-1).cast("long")).unionByName(now_days.withColumn("sign", F.lit(1).cast("long")))
    act = _act_events(versions, window).select("at", F.lit(0).cast("long").alias("seen"), "act")

    spans = _stored(_new_spans(tx, changed, touched), "activity-spans")
    seen = spans.select(F.inline(F.array(
        F.struct(F.col("old_first").alias("at"), F.lit(-1).cast("long").alias("seen"), F.lit(0).cast("long").alias("act")),
        F.struct(F.col("first_dt").alias("at"), F.lit(1).cast("long").alias("seen"), F.lit(0).cast("long").alias("act")))))
    tx.upsert(SPANS, spans.where("first_dt is not null").select(*S.CUSTOMER_SPAN.fieldNames()), ["ckey"], S.CUSTOMER_SPAN)
    if spans.where("first_dt is null").limit(1).count():            # customers without any order left: null spans
        tx.upsert(SPANS, spans.where("first_dt is null").select(*S.CUSTOMER_SPAN.fieldNames()), ["ckey"], S.CUSTOMER_SPAN)

    # one row per calendar day from here on
    diff = act.unionByName(seen).where("at is not null").groupBy("at").agg(F.sum("seen").alias("seen"), F.sum("act").alias("act"))
    diff = _stored(diff.where("seen <> 0 OR act <> 0"), "activity-deltas")
    days = sorted(str(r[0]) for r in diff.select("at").collect())
    if days:
        total = tx.read(DELTAS, S.ACTIVITY_DELTAS, days, "at").unionByName(diff).groupBy("at").agg(
            F.sum("seen").alias("seen"), F.sum("act").alias("act"))
        tx.replace(DELTAS, total, "at", days, S.ACTIVITY_DELTAS)
    later = {d for d in tx.parts(ACTIVITY) if days and d >= days[0]}
    publish = sorted(set(dates) | later)
    tx.replace(ACTIVITY, activity(spark, tx, publish), "dt", publish, S.CUSTOMER_ACTIVITY)


def _new_spans(tx: Transaction, changed: DataFrame, touched: DataFrame) -> DataFrame:
    """``ckey, first_dt, last_dt, old_first`` of the touched customers; after
    the new pairs are in the transaction."""
    n = tx.buckets(SPANS)
    bucket = F.pmod(F.xxhash64("ckey"), F.lit(n)).cast("int")
    buckets = [r[0] for r in touched.select(bucket.alias("b")).distinct().collect()]
    old = tx.read_keyed(SPANS, S.CUSTOMER_SPAN, ["ckey"], buckets).select(
        "ckey", F.col("first_dt").alias("old_first"), F.col("last_dt").alias("old_last"))
    per = changed.groupBy("ckey").agg(
        F.min(F.when(F.col("s") > 0, F.col("dt"))).alias("add_first"), F.max(F.when(F.col("s") > 0, F.col("dt"))).alias("add_last"),
        F.min(F.when(F.col("s") < 0, F.col("dt"))).alias("cut_first"), F.max(F.when(F.col("s") < 0, F.col("dt"))).alias("cut_last"))
    rows = per.join(old, "ckey", "left").withColumn(
        "lost", F.coalesce((F.col("cut_first") <= F.col("old_first")) | (F.col("cut_last") >= F.col("old_last")), F.lit(False)))
    kept = rows.where(~F.col("lost")).select("ckey", F.least("old_first", "add_first").alias("first_dt"),
                                             F.greatest("old_last", "add_last").alias("last_dt"), "old_first")
    if rows.where("lost").limit(1).count() == 0:
        return kept
    lost = rows.where("lost").select("ckey", "old_first")
    every = (tx.read(DAYS, S.CUSTOMER_DAYS).join(lost.select("ckey"), "ckey", "left_semi")
             .groupBy("ckey").agg(F.min("dt").alias("first_dt"), F.max("dt").alias("last_dt")))
    return kept.unionByName(lost.join(every, "ckey", "left").select("ckey", "first_dt", "last_dt", "old_first"))


def activity(spark: SparkSession, tx: Transaction, dates: list[str]) -> DataFrame:
    """E8 of ``dates`` from the stored deltas: a running sum over the calendar."""
    spine = spark.createDataFrame([(d,) for d in dates], "d string").select(
        F.col("d").cast("date").alias("at"), F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("act"), F.lit(True).alias("spine"))
    deltas = tx.read(DELTAS, S.ACTIVITY_DELTAS, part="at").withColumn("spine", F.lit(False))
    per_day = deltas.unionByName(spine).groupBy("at").agg(F.sum("seen").alias("seen"), F.sum("act").alias("act"), F.max("spine").alias("spine"))
    upto = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)     # one row per calendar day
    run = per_day.withColumns({"n": F.sum("seen").over(upto), "a": F.sum("act").over(upto)})
    return run.where("spine").select(F.col("at").alias("dt"), F.col("a").cast("int").alias("active_customers"),
                                     (F.col("n") - F.col("a")).cast("int").alias("dormant_customers"))


def last_orders(tx: Transaction) -> DataFrame:
    """E7 from the state: last order date per customer over everything loaded."""
    spans = tx.read_keyed(SPANS, S.CUSTOMER_SPAN, ["ckey"]).where("last_dt is not null")
    return spans.select(F.when(F.col("ckey") != "", F.expr("substring(ckey, 2)")).alias("customer_id"), F.col("last_dt").alias("last_order_dt"))
