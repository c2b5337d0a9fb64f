"""Composite jobs: ingest, star build, aggregates, anomalies (K1-K7).

A run over a set of dates gives the tables that runs over each date would
give: every requested date has its rows (or its zero row), the gates judge
each date alone, and dates that a late date changes are computed again.

Each job takes a warehouse root (a folder under the shared checkpoint
root on a cluster) and a date ``ds`` - or, for the backfill forms, a set
of dates processed in ONE Spark job per table (no per-date loop).  A job
publishes all its tables by one commit (``souk.operators.store``); where another
writer has changed what it read, it runs again.  Re-running a job gives the
same tables (K6).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk import schemas as S
from souk.functions.dates import in_dates
from souk.operators import activity, anomaly, metrics, quality, star
from souk.operators.sinks import one_per_key, sequential_id
from souk.operators.store import KEEP_SECONDS, CommitConflict, Store, Transaction
from souk.session import shared_dir
from souk.sources import landing

RETRIES = 5                     # runs of a job that keeps meeting other writers
BROADCAST_IDS = 500_000         # order ids (about 30 bytes each) that may be broadcast; checked by a count


class EmptySourceError(RuntimeError):
    """The source table has no date to process."""


@dataclass(frozen=True)
class Warehouse:
    root: str
    raw_root: str | None = None   # landing zone; defaults to {root}/raw

    def raw(self) -> str:
        return self.raw_root or f"{self.root}/raw"

    def store(self, spark: SparkSession) -> Store:
        return Store(spark, f"{self.root}/tables")


ALERTS = S._s(("event", S.T.StringType()), ("dt", S.T.DateType()), ("n_anomalies", S.T.IntegerType()))

# Tables of dates, replaced date by date.
TABLE_SCHEMAS = {
    ("staging", "orders"): S.ORDERS, ("dwh", "fact_orders"): S.ORDERS,
    ("staging", "rejects_orders"): S.REJECTS, ("staging", "rejects_sellers"): S.REJECTS,
    ("staging", "rejects_products"): S.REJECTS, ("staging", "repairs"): S.REPAIRS,
    ("analytics", "top_sellers"): S.TOP_SELLERS, ("analytics", "anomalies"): S.ANOMALIES,
    ("analytics", "daily_revenue"): S.DAILY_REVENUE,
    ("analytics", "category_breakdown"): S.CATEGORY_BREAKDOWN,
    ("analytics", "customer_activity"): S.CUSTOMER_ACTIVITY,
    ("analytics", "customer_days"): S.CUSTOMER_DAYS,
    ("analytics", "alerts"): ALERTS,
}
# Keyed tables: hash buckets, upserted.
KEYED_SCHEMAS = {(layer, table): (schema, S.PRIMARY_KEYS[table]) for layer, table, schema in (
    ("staging", "sellers", S.SELLERS), ("staging", "products", S.PRODUCTS), ("dwh", "dim_seller", S.SELLERS),
    ("dwh", "dim_product", S.PRODUCTS), ("dwh", "dim_customer", S.CUSTOMERS), ("dwh", "dim_date", S.DIM_DATE))}
ORDERS, KEYS, FACT, ANOMALIES = "staging/orders", "staging/order_keys", "dwh/fact_orders", "analytics/anomalies"


def _read(tx: Transaction, layer: str, table: str, dates=None) -> DataFrame:
    if (layer, table) in KEYED_SCHEMAS:
        schema, keys = KEYED_SCHEMAS[(layer, table)]
        return tx.read_keyed(f"{layer}/{table}", schema, keys)
    return tx.read(f"{layer}/{table}", TABLE_SCHEMAS[(layer, table)], dates, "dt")


def read_table(spark: SparkSession, wh: Warehouse, layer: str, table: str, ds=None, dates=None) -> DataFrame:
    """A4/A5: a published table, or its rows of ``ds`` / ``dates`` (only files that hold them are opened)."""
    days = [ds] if ds is not None and dates is None else dates
    df = _read(wh.store(spark).begin(), layer, table, days)
    if days is not None and (layer, table) in KEYED_SCHEMAS:
        df = df.where(in_dates("dt", days))
    return df


def stored_anomalies(spark: SparkSession, wh: Warehouse, dates=None) -> DataFrame:
    """The anomalies with their ``id`` and ``detected_at``."""
    return wh.store(spark).begin().read(ANOMALIES, S.STORED_ANOMALIES, dates, "dt")


def loaded_dates(spark: SparkSession, wh: Warehouse, layer: str, table: str) -> list[str]:
    """Dates with rows, from the commit log (no file is opened)."""
    return sorted(wh.store(spark).begin().parts(f"{layer}/{table}"))


def latest_date_of(spark: SparkSession, wh: Warehouse, layer: str, table: str) -> str:
    """A6 on a stored table; Q2: no date -> error."""
    return _latest(wh.store(spark).begin(), f"{layer}/{table}")


def _latest(tx: Transaction, name: str) -> str:
    days = tx.parts(name)
    if not days:
        raise EmptySourceError(f"{name.replace('/', '.')} has no loaded date")
    return max(days)


def latest_loaded_date(df: DataFrame):
    """A6 resolved to a value (one row to the driver); Q2: empty -> error."""
    v = df.agg(F.max("dt")).first()[0]
    if v is None:
        raise EmptySourceError("no loaded date")
    return v


def _days(spark: SparkSession, dates) -> DataFrame:
    """The requested dates as a frame (bounded by the calendar)."""
    return spark.createDataFrame([(str(d),) for d in dates], "dt string").select(F.col("dt").cast("date").alias("dt"))


def in_commit(spark: SparkSession, wh: Warehouse, job: Callable[[Transaction], object], tries: int = RETRIES):
    """Run ``job`` and publish all its writes at once; again, on the newest
    state, if another writer has changed what it read."""
    for k in range(tries):
        tx = wh.store(spark).begin()
        out = job(tx)
        try:
            tx.commit()
            return out
        except CommitConflict:
            if k == tries - 1:
                raise


# --- K1 ingest ---------------------------------------------------------------

def ingest(spark: SparkSession, wh: Warehouse, ds=None, dates=None, gate: bool = True,
           layout: landing.Layout | None = None) -> dict:
    """K1: landing zone -> staging for one date ``ds`` or a set of ``dates``.

    Sellers / products snapshots are upserted (one row per key; a snapshot older
    than the one last taken over only adds unseen keys); the orders of each date
    replace that date.  The gate runs before publishing (Q7) and judges each date
    alone: the dates that pass are published.  With ``ds`` a failing date raises;
    with ``dates`` the result lists the failing ones.  An order id that staging
    already holds under another date, or that an earlier date of the run has,
    fails its date (the primary key of the table), and so does a value beyond its
    column's length (J9).

    Rejected records are published by date (``staging.rejects_<entity>``);
    repaired ones (:func:`replay`) take their place.
    """
    days = [str(ds)] if ds is not None else sorted({str(d) for d in dates})
    run = shared_dir(spark, "ingest")
    raw = landing.read_raw(spark, wh.raw(), "orders", dates=days, as_text=True, layout=layout)
    marked = landing.marked_rows(raw, "orders").withColumn("rejected", F.col("reject_reason") != "")
    # only rejects keep their text; by date once, so staging and the fact are written from it as it lies
    marked = marked.withColumns({c: F.when(F.col("rejected"), F.col(c)) for c in ("raw", landing.SOURCE)})
    marked.hint("rebalance", "path_dt").sortWithinPartitions("rejected", "path_dt", "order_id").write.partitionBy("rejected").parquet(run)
    marked = spark.read.schema(marked.schema).parquet(run)

    def job(tx: Transaction) -> dict:
        staged, rejects = _repaired(tx, marked, days)
        for entity in ("sellers", "products"):
            _stage_dimension(tx, wh, entity, days[-1], layout)
        failed: dict[str, list[str]] = {}
        if gate:
            repeats = _repeated_ids(tx, staged, days)
            report = quality.order_rule_report_by_date(staged, _read(tx, "staging", "sellers"), repeats.where("n > 1").select("dt", "order_id", "n"))
            report = report.where(~F.col("passed")).select("dt", "name", "actual")
            limits = quality.domain_report_by_date(staged, S.VARCHAR_LIMITS["orders"])
            for r in report.unionByName(limits).unionByName(_reused_ids(repeats)).collect():
                failed.setdefault(str(r["dt"]), []).append(f"[{r['name']}] value={r['actual']}")
            if ds is not None and failed:
                raise quality.DataQualityError("\n".join(failed[days[0]]))
        passed = [d for d in days if d not in failed]
        tx.replace(ORDERS, staged, "dt", passed, S.ORDERS, clustered=True)
        tx.replace("staging/rejects_orders", rejects, "dt", days, S.REJECTS)
        _index_keys(tx, staged, passed)
        return {"run": run, "published": passed, "failed": failed, "rejects": rejects.select("raw", "reject_reason")}

    return in_commit(spark, wh, job)


def _repaired(tx: Transaction, marked: DataFrame, days: list[str]) -> tuple[DataFrame, DataFrame]:
    """Staged orders and rejects; a reject that has a stored repair is staged from it."""
    staged = marked.where(~F.col("rejected")).select(*S.ORDER_COLUMNS)
    rejects = marked.where("rejected").select(F.col("path_dt").alias("dt"), F.lit("orders").alias("entity"), "raw", "reject_reason", landing.SOURCE)
    repairs = tx.read("staging/repairs", S.REPAIRS, days, "dt").where("entity = 'orders'")
    if not any(tx.parts("staging/repairs").get(d) for d in days):
        return staged, rejects
    hits = rejects.join(repairs.select("dt", "raw", "record"), ["dt", "raw"])
    again = landing.marked_rows(hits.select(
        F.from_json("record", landing.text_schema(S.ORDERS)).alias("r"), F.col("dt").alias("path_dt"), landing.SOURCE).select(
        "r.*", "path_dt", landing.SOURCE), "orders")
    good = again.where("reject_reason = ''").select(*S.ORDER_COLUMNS)
    still = again.where("reject_reason <> ''").select(F.col("path_dt").alias("dt"), F.lit("orders").alias("entity"), "raw", "reject_reason", landing.SOURCE)
    left = rejects.join(repairs.select("dt", "raw"), ["dt", "raw"], "left_anti").select(*S.REJECTS.fieldNames())
    return staged.unionByName(good), left.unionByName(still)


def _stage_dimension(tx: Transaction, wh: Warehouse, entity: str, ds: str, layout) -> None:
    """Upsert the entity's snapshot as of ``ds`` into staging; rows with a value
    beyond its column's length are rejects (J9)."""
    spark, name = tx.spark, f"staging/{entity}"
    schema, keys = KEYED_SCHEMAS[("staging", entity)]
    taken = landing.latest_snapshot_date(spark, wh.raw(), entity, ds, layout)
    raw = landing.read_snapshot_raw(spark, wh.raw(), entity, ds, as_text=True, layout=layout)
    marked = quality.with_limits(landing.marked_rows(raw, entity), S.VARCHAR_LIMITS[entity])
    rows = marked.where("reject_reason = ''").select(*schema.fieldNames()).where(F.col(keys[0]).isNotNull())
    if taken is None:
        return
    newest = tx.prop(name, "snapshot")
    tx.upsert(name, rows, keys, schema, update=newest is None or taken >= newest, all_buckets=True)
    if newest is None or taken > newest:
        tx.set_prop(name, "snapshot", taken)
    bad = marked.where("reject_reason <> ''").select(F.lit(taken).cast("date").alias("dt"), F.lit(entity).alias("entity"), "raw", "reject_reason", landing.SOURCE)
    tx.replace(f"staging/rejects_{entity}", bad, "dt", [taken], S.REJECTS)


def _repeated_ids(tx: Transaction, staged: DataFrame, days: list[str]) -> DataFrame:
    """``dt, order_id, n, old, first``: the ids of the run that come more than once
    or that a date of staging which is not replaced holds too (``old``), a row per
    date with the orders ``n`` of the id; ``first`` is the id's earliest date.

    One shuffle of ids, with sizes that do not grow with an id's copies; only ids of
    several dates are counted again, by date.  The ids of staging come from the key
    index: only buckets that the run's ids fall into are opened.  An index row counts
    while its stamp is its date's.
    """
    spark = tx.spark
    ids = staged.select("order_id", "dt").where(F.col("order_id").isNotNull())
    per = ids.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"), F.min("dt").alias("first"), F.max("dt").alias("last"))
    stamps = [(d, tx.prop(KEYS, f"stamp:{d}")) for d in sorted(tx.parts(ORDERS)) if d not in set(days)]
    if stamps:
        buckets = [r[0] for r in ids.select(tx.bucket_of(KEYS, ["order_id"])).distinct().collect()]
        live = spark.createDataFrame(stamps, "day string, stamp long").select(F.col("day").cast("date").alias("dt"), "stamp")
        held = tx.read_keyed(KEYS, S.ORDER_KEYS, ["order_id"], buckets).join(F.broadcast(live), ["dt", "stamp"])    # one row per date
        per = per.join(held.select("order_id", F.lit(True).alias("old")).distinct(), "order_id", "left").withColumn("old", F.coalesce("old", F.lit(False)))
    else:
        per = per.withColumn("old", F.lit(False))
    found = per.where("n > 1 OR old")
    path = shared_dir(spark, "repeated")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    rows = found.where("first = last").select(F.col("first").alias("dt"), "order_id", "n", "old", "first")
    several = found.where("first < last")
    if several.isEmpty():
        return rows
    held = several.select("order_id", "old", "first")
    by_date = (ids.join(F.broadcast(held) if held.count() <= BROADCAST_IDS else held, "order_id")       # before the count: only these are moved
               .groupBy("dt", "order_id", "old", "first").agg(F.count(F.lit(1)).alias("n")))
    return rows.unionByName(by_date.select(*rows.columns))


def _reused_ids(repeats: DataFrame) -> DataFrame:
    """Per date: order ids that an earlier date of the run, or a date of staging
    that is not replaced, has too."""
    return (repeats.where("old OR dt > first").groupBy("dt").agg(F.count(F.lit(1)).alias("actual"))
            .select("dt", F.lit("order_id_of_another_date").alias("name"), "actual"))


def _index_keys(tx: Transaction, staged: DataFrame, days: list[str]) -> None:
    """Add the ids of ``days`` to the key index; what it had of them is dead from now on."""
    if not days:
        return
    stamp = tx._order()
    rows = staged.where(F.col("order_id").isNotNull() & in_dates("dt", days))
    tx.append_keyed(KEYS, rows.select("order_id", "dt", F.lit(stamp).cast("long").alias("stamp")), ["order_id"], S.ORDER_KEYS)
    for d in days:
        tx.set_prop(KEYS, f"stamp:{d}", stamp)


def replay(spark: SparkSession, wh: Warehouse, repairs: DataFrame) -> dict:
    """Restage repaired orders: ``repairs`` has ``dt``, ``raw`` (the rejected
    text) and ``record`` (the JSON that takes its place).

    Only records that are in quarantine are accepted, so a second replay does
    nothing; the repair is kept and holds for later ingests of the date.  The
    dates of accepted repairs run again through all jobs.
    """
    def job(tx: Transaction) -> list[str]:
        asked = repairs.select(F.col("dt").cast("date").alias("dt"), F.lit("orders").alias("entity"), "raw", "record")
        held = _read(tx, "staging", "rejects_orders").select("dt", "raw").distinct()
        path = shared_dir(spark, "repairs")
        one_per_key(asked, ["dt", "entity", "raw"]).join(held, ["dt", "raw"], "left_semi").select(*S.REPAIRS.fieldNames()).write.parquet(path)
        taken = spark.read.schema(S.REPAIRS).parquet(path)
        days = sorted(str(r[0]) for r in taken.select("dt").distinct().collect())
        if days:
            before = tx.read("staging/repairs", S.REPAIRS, days, "dt")
            both = before.join(taken, ["dt", "entity", "raw"], "left_anti").select(*S.REPAIRS.fieldNames()).unionByName(taken)
            tx.replace("staging/repairs", both, "dt", days, S.REPAIRS)
        return days
    days = in_commit(spark, wh, job)
    return backfill(spark, wh, days) if days else {"failed": {}, "published": [], "fact_rows": 0, "anomalies": 0}


# --- K2 star -------------------------------------------------------------------

def build_star(spark: SparkSession, wh: Warehouse, ds=None, dates=None) -> int:
    """K2: dimensions and the fact of ``ds`` / ``dates`` (default: the latest
    loaded date, A6).  Only these dates are read: no other can bring a new
    customer or day.  A date with an unknown seller or product is not published
    (J8; with one date it raises).  Returns the number of fact rows written (B6)."""
    rows, failed = in_commit(spark, wh, lambda tx: _build_star(tx, ds, dates))
    if failed and dates is None:
        raise quality.DataQualityError("\n".join(line for lines in failed.values() for line in lines))
    return rows


def _build_star(tx: Transaction, ds=None, dates=None) -> tuple[int, dict[str, list[str]]]:
    days = _chosen(tx, ORDERS, ds, dates)
    orders = _read(tx, "staging", "orders", days)
    for entity, dim in (("sellers", "dim_seller"), ("products", "dim_product")):
        schema, keys = KEYED_SCHEMAS[("dwh", dim)]
        tx.upsert(f"dwh/{dim}", _read(tx, "staging", entity), keys, schema, all_buckets=True)
    # customers and dates get their dimension rows from these orders, in this commit
    fks = {c: S.FACT_FOREIGN_KEYS[c] for c in ("seller_id", "product_id")}
    failed: dict[str, list[str]] = {}
    for r in quality.foreign_key_report_by_date(orders, {d: _read(tx, "dwh", d) for d, _ in fks.values()}, fks).collect():
        failed.setdefault(str(r["dt"]), []).append(f"[{r['name']}] keys={r['actual']}")
    passed = [d for d in days if d not in failed]
    good = orders if not failed else orders.where(in_dates("dt", passed))
    fresh = star.customer_rows(good.select("customer_id"))
    tx.upsert("dwh/dim_customer", fresh, ["customer_id"], S.CUSTOMERS, update=False)
    tx.upsert("dwh/dim_date", star.date_rows(good), ["dt"], S.DIM_DATE, update=False)
    return tx.replace(FACT, star.build_fact_orders(good), "dt", passed, S.ORDERS, clustered=True), failed


def _chosen(tx: Transaction, name: str, ds, dates) -> list[str]:
    if dates is not None:
        return sorted({str(d) for d in dates})
    return [str(ds) if ds is not None else _latest(tx, name)]


# --- K3 aggregates ---------------------------------------------------------------

def aggregate(spark: SparkSession, wh: Warehouse, ds=None, dates=None) -> int:
    """K3: top sellers, daily revenue, categories, customer activity; every
    requested date has its revenue and activity row, with or without orders, and
    the activity of later dates that it changes is published too.  Reads the
    fact of these dates only.  Returns the number of top seller rows (B6)."""
    def job(tx: Transaction) -> int:
        days = _chosen(tx, FACT, ds, dates)
        fact = _read(tx, "dwh", "fact_orders", days)
        n = publish(tx, "top_sellers", fact, days)
        for table in ("daily_revenue", "category_breakdown", "customer_activity"):
            publish(tx, table, fact, days)
        return n
    return in_commit(spark, wh, job)


def publish(tx: Transaction, table: str, fact: DataFrame, days: list[str], threshold=S.ANOMALY_THRESHOLD_PCT) -> int:
    """Replace one analytics table's rows of ``days`` from ``fact``, which holds
    the orders of these days (anomalies: and of the look-back before each).
    Returns the rows written."""
    if table == "customer_activity":
        activity.update(tx, fact, days)
        return len(days)
    if table == "anomalies":
        found = anomaly.detect_anomalies_all(fact, _read(tx, "dwh", "dim_seller"), threshold, dates=days)
        return tx.replace(ANOMALIES, _with_ids(tx, found, days), "dt", days, S.STORED_ANOMALIES, ["seller_id"])
    rows, sort = {
        "top_sellers": lambda: (metrics.top_sellers(fact, _read(tx, "dwh", "dim_seller")), ["seller_id"]),
        "daily_revenue": lambda: (metrics.daily_revenue_of(fact, _days(tx.spark, days)), None),
        "category_breakdown": lambda: (metrics.category_breakdown(fact, _read(tx, "dwh", "dim_product")), None),
    }[table]()
    return tx.replace(f"analytics/{table}", rows, "dt", days, TABLE_SCHEMAS[("analytics", table)], sort)


# --- K4 / K5 anomalies --------------------------------------------------------------

def detect(spark: SparkSession, wh: Warehouse, ds=None, dates=None,
           threshold=S.ANOMALY_THRESHOLD_PCT) -> int:
    """K4 + K5: anomalies of ``ds`` (or of ``dates``) and the alert rows; reads
    those dates and the look-back before each.  An anomaly found again unchanged
    keeps its id and time of detection; new ones get the next ids.  Returns the
    anomalies written."""
    def job(tx: Transaction) -> int:
        days = _chosen(tx, FACT, ds, dates)
        read = {str(_dt.date.fromisoformat(d) - _dt.timedelta(days=k)) for d in days for k in range(S.MOVING_AVG_DAYS + 1)}
        n = publish(tx, "anomalies", _read(tx, "dwh", "fact_orders", read), days, threshold)
        tx.replace("analytics/alerts", anomaly.alert_events(tx.read(ANOMALIES, S.ANOMALIES, days, "dt")), "dt", days, ALERTS)
        return n
    return in_commit(spark, wh, job)


def _with_ids(tx: Transaction, found: DataFrame, days: list[str]) -> DataFrame:
    """Ids from the stored high-water mark, reserved by this commit."""
    path = shared_dir(tx.spark, "anomalies")
    values = [c for c in S.ANOMALIES.fieldNames() if c not in ("dt", "seller_id")]
    held = tx.read(ANOMALIES, S.STORED_ANOMALIES, days, "dt").select("dt", "seller_id", "id", "detected_at", F.struct(*values).alias("was"))
    same = F.col("was").isNotNull() & F.struct(*values).eqNullSafe(F.col("was"))
    joined = found.join(held, ["dt", "seller_id"], "left").withColumn("same", same).drop("was")
    joined.write.parquet(path)
    stored = tx.spark.read.schema(joined.schema).parquet(path)
    first = int(tx.prop(ANOMALIES, "next_id", 1))
    fresh = stored.where(~F.col("same")).drop("id", "detected_at", "same")
    n = fresh.count()
    tx.set_prop(ANOMALIES, "next_id", first + n)
    cols = S.STORED_ANOMALIES.fieldNames()
    numbered = sequential_id(fresh, ["dt", "seller_id"]).select(
        (F.col("id") + (first - 1)).alias("id"), *S.ANOMALIES.fieldNames(), F.current_timestamp().alias("detected_at"))
    return stored.where("same").select(*cols).unionByName(numbered.select(*cols))


# --- K6 / K7 -------------------------------------------------------------------------

def run_day(spark: SparkSession, wh: Warehouse, ds) -> int:
    """K1-K4 for one date, in order; later dates that it changes follow."""
    return backfill(spark, wh, [ds], strict=True)["anomalies"]


def backfill(spark: SparkSession, wh: Warehouse, dates, strict: bool = False) -> dict:
    """K7: K1-K4 over a set of dates, one job per table (no loop over dates).

    Dates that fail a gate are listed and left as they were; with ``strict``
    they raise.  Loaded dates whose results depend on the new ones (anomalies
    of the 7 days after, activity of all later days) are computed again, so
    the tables do not depend on the order in which dates arrive.  At the end
    tables of many small runs are merged and old files deleted.
    """
    dates = sorted({str(d) for d in dates})
    got = ingest(spark, wh, ds=dates[0]) if strict and len(dates) == 1 else ingest(spark, wh, dates=dates)
    days = got["published"]
    out = {"failed": got["failed"], "published": days, "fact_rows": 0, "anomalies": 0}
    if not days:
        return out
    out["fact_rows"], orphans = in_commit(spark, wh, lambda tx: _build_star(tx, dates=days))
    if orphans:
        if strict:
            raise quality.DataQualityError("\n".join(line for lines in orphans.values() for line in lines))
        out["failed"] = {**out["failed"], **orphans}
        out["published"] = days = [d for d in days if d not in orphans]
    if days:
        aggregate(spark, wh, dates=days)
        after = {str(_dt.date.fromisoformat(d) + _dt.timedelta(days=k)) for d in days for k in range(1, S.MOVING_AVG_DAYS + 1)}
        near = sorted((after & set(loaded_dates(spark, wh, "dwh", "fact_orders"))) - set(days))
        out["anomalies"] = detect(spark, wh, dates=days)
        if near:
            detect(spark, wh, dates=near)
    maintain(spark, wh)
    return out


def maintain(spark: SparkSession, wh: Warehouse, keep_seconds: float = KEEP_SECONDS) -> None:
    """Merge tables of many small runs; delete runs and log files that nothing
    refers to and no reader of the last ``keep_seconds`` can still hold."""
    store = wh.store(spark)
    store.compact()
    store.vacuum(keep_seconds)


def table_summary(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """(table, n_rows, revenue) for the partitioned tables of a warehouse."""
    parts = []
    for layer, table in [("staging", "orders"), ("dwh", "fact_orders"), ("analytics", "top_sellers"),
                         ("analytics", "daily_revenue"), ("analytics", "category_breakdown"),
                         ("analytics", "customer_activity"), ("analytics", "anomalies")]:
        df = read_table(spark, wh, layer, table)
        money = "total_amount" if "total_amount" in df.columns else ("revenue" if "revenue" in df.columns else None)
        rev = F.sum(money).cast(S.T.DecimalType(18, 2)) if money else F.lit(None).cast(S.T.DecimalType(18, 2))
        parts.append(df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"), rev.alias("revenue"))
                     .select(F.lit(table).alias("table_name"), "n_rows", "revenue"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


CONTENTS = [("staging", "orders"), ("dwh", "fact_orders"), ("analytics", "top_sellers"), ("analytics", "daily_revenue"),
            ("analytics", "category_breakdown"), ("analytics", "customer_activity"), ("analytics", "anomalies")]


def table_contents(spark: SparkSession, wh: Warehouse) -> dict[str, DataFrame]:
    """The published tables as they are now; runs are never overwritten, so the
    frames still show this state after later jobs."""
    tx = wh.store(spark).begin()
    out = {t: _read(tx, layer, t) for layer, t in CONTENTS if t != "anomalies"}
    return {**out, "anomalies": tx.read(ANOMALIES, S.STORED_ANOMALIES, None, "dt")}


def differing_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that one of two tables holds more often than the other (K6)."""
    cols = before.columns
    both = before.select(*cols, F.lit(1).alias("_s")).unionByName(after.select(*cols, F.lit(-1).alias("_s")))
    return both.groupBy(*cols).agg(F.sum("_s").alias("_s")).where("_s <> 0")


def differing_dates(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> dict[str, list]:
    """Table -> dates whose rows are not the same in both, from the number of rows and four
    sums of two 64-bit hashes of whole rows: one pass over both, in which no row is moved.
    A null leaves such a hash as it is, so which columns are null is hashed too."""
    def sums(t: str, df: DataFrame, sign: int) -> DataFrame:
        nulls = reduce(add, [F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(df.columns)])
        hashed = df.select("dt", *[F.xxhash64(F.lit(k), nulls, *df.columns).alias(f"h{k}") for k in range(2)])
        halves = [half for k in range(2) for half in (F.col(f"h{k}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"h{k}", 32))]
        one = hashed.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(f"s{i}") for i, h in enumerate(halves)])
        return one.select(F.lit(t).alias("t"), "dt", *[(F.col(c) * sign).alias(c) for c in ("n", "s0", "s1", "s2", "s3")])

    rows = reduce(DataFrame.unionByName, [sums(t, side[t], sign) for t in before for side, sign in ((before, 1), (after, -1))])
    sides = rows.groupBy("t", "dt").agg(*[F.sum(c).alias(c) for c in ("n", "s0", "s1", "s2", "s3")])       # two rows per table and date
    out: dict[str, list] = {t: [] for t in before}
    for r in sides.where("n <> 0 OR s0 <> 0 OR s1 <> 0 OR s2 <> 0 OR s3 <> 0").select("t", "dt").collect():
        out[r["t"]].append(r["dt"])
    return out


def same_summary(summary: DataFrame, before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """``summary`` with ``n_rows`` -1 for a table whose rows are not all the same (ids included).
    Only dates whose hashes differ are compared row by row."""
    dates = differing_dates(before, after)

    def of(t: str, df: DataFrame) -> DataFrame:
        days = [d for d in dates[t] if d is not None]
        found = in_dates("dt", days) if days else F.lit(False)
        return df.where(found | F.col("dt").isNull() if len(days) < len(dates[t]) else found)

    parts = [differing_rows(of(t, before[t]), of(t, after[t])).agg(F.count(F.lit(1)).alias("_d")).select(F.lit(t).alias("table_name"), "_d") for t in before]
    diff = parts[0]
    for p in parts[1:]:
        diff = diff.unionByName(p)
    return summary.join(diff, "table_name").select(
        "table_name", F.when(F.col("_d") == 0, F.col("n_rows")).otherwise(F.lit(-1).cast("bigint")).alias("n_rows"), "revenue")
