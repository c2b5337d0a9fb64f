"""The query catalog: one Spark job per operator, over a scale-factor folder.

Every entry takes ``(spark, sf_dir)``, reads the benchmark tables of that
folder (through ``souk.sources.fixtures``) and returns a DataFrame whose
columns match the same key in ``souk.plans.oracle``.  Date-bound entries
use ``ds`` = the latest order date, resolved inside the job.  Entries for
writes (sinks, landing zone, pipelines, stream) write under a fresh folder
below the session's shared checkpoint root and return the read-back table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from souk import schemas as S
from souk.functions import days_before, drop_pct, status_not_in
from souk.operators import anomaly, joins, metrics, quality, sinks, star
from souk.plans import dashboard, pipeline
from souk.session import shared_dir
from souk.sources import landing
from souk.sources.fixtures import Fixture

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


def _ds(fact: DataFrame):
    """ds = latest order date, as a lazy scalar subquery."""
    return metrics.latest_date(fact)


def _ds_value(fact: DataFrame):
    """ds as a value (one scalar to the driver) for path-level operations."""
    return pipeline.latest_loaded_date(fact)


def _rank(df: DataFrame, *order) -> DataFrame:
    """rank_no over a total order; used on results already cut to a few rows."""
    return df.withColumn("rank_no", F.row_number().over(Window.orderBy(*order)).cast("int"))


def _key_num(col: str):
    return F.col(col).cast("long")


# --- A: scans / sources ---------------------------------------------------------

@query("scan_raw_orders")
def _scan_raw_orders(spark, sf):
    base = shared_dir(spark, "landing")
    fx = Fixture(spark, sf)
    landing.land(fx.raw_orders, base, "orders", spread=["order_id"], n_dates=len(_fact_dates(spark, sf)))
    return landing.read_raw(spark, base, "orders").select(*S.ORDER_COLUMNS)


def _snapshot_roundtrip(spark, sf, entity: str, frame: DataFrame) -> DataFrame:
    """Land a stale snapshot the day before ds and the real one at ds; read as of ds."""
    fx = Fixture(spark, sf)
    ds = _ds_value(fx.fact)
    base = shared_dir(spark, "landing")
    stale = frame.withColumn("name", F.lit("stale"))
    landing.land(stale, base, entity, ds=days_before_value(ds, 1))
    landing.land(frame, base, entity, ds=ds)
    schema = landing.ENTITY_SCHEMAS[entity]
    return landing.read_snapshot_raw(spark, base, entity, ds).select(*schema.fieldNames())


def days_before_value(ds, n: int):
    import datetime as _dt
    return ds - _dt.timedelta(days=n)


@query("scan_raw_sellers")
def _scan_raw_sellers(spark, sf):
    return _snapshot_roundtrip(spark, sf, "sellers", Fixture(spark, sf).sellers)


@query("scan_raw_products")
def _scan_raw_products(spark, sf):
    return _snapshot_roundtrip(spark, sf, "products", Fixture(spark, sf).products)


@query("raw_json_roundtrip")
def _raw_json_roundtrip(spark, sf):
    base = shared_dir(spark, "landing")
    fact = Fixture(spark, sf).fact
    landing.land(fact, base, "orders", spread=["order_id"], n_dates=len(_fact_dates(spark, sf)))
    return landing.read_raw(spark, base, "orders").select(*S.ORDER_COLUMNS)


def _daily_table(spark, sf) -> tuple[str, DataFrame]:
    fact = Fixture(spark, sf).fact
    path = shared_dir(spark, "daily_revenue")
    sinks.replace_partitions(metrics.daily_revenue_zero_filled(fact), path, _fact_dates(spark, sf))
    return path, fact


@query("scan_partition")
def _scan_partition(spark, sf):
    path, fact = _daily_table(spark, sf)
    return sinks.read_partitioned(spark, path, S.DAILY_REVENUE, _ds_value(fact))


@query("latest_partition")
def _latest_partition(spark, sf):
    path, _ = _daily_table(spark, sf)
    latest = max(sinks.current_dates(spark, path))       # from the manifest; no file is opened
    return sinks.read_partitioned(spark, path, S.DAILY_REVENUE, latest).agg(F.max("dt").alias("latest_dt"))


# --- B: sinks -------------------------------------------------------------------------

@query("replace_partition_idempotent")
def _replace_partition_idempotent(spark, sf):
    fact = Fixture(spark, sf).fact
    daily = metrics.daily_revenue_zero_filled(fact)
    dates = _fact_dates(spark, sf)
    path = shared_dir(spark, "daily_revenue")
    sinks.replace_partitions(daily, path, dates)
    sinks.replace_partitions(daily, path, dates)
    return sinks.read_partitioned(spark, path, S.DAILY_REVENUE)


@query("replace_partition_empty")
def _replace_partition_empty(spark, sf):
    path, fact = _daily_table(spark, sf)
    ds = _ds_value(fact)
    sinks.replace_partition(metrics.daily_revenue_zero_filled(fact).limit(0), path, ds)
    return sinks.read_partitioned(spark, path, S.DAILY_REVENUE)


def _upsert(spark, frame: DataFrame, key: str, schema) -> DataFrame:
    """target = keys k % 3 <> 0 named 'old'; source = keys k % 2 = 0."""
    path = shared_dir(spark, "dim")
    target = frame.where(_key_num(key) % 3 != 0).withColumn("name", F.lit("old"))
    source = frame.where(_key_num(key) % 2 == 0)
    sinks.write_snapshot(target.select(*schema.fieldNames()), path)
    sinks.upsert_table(spark, path, source, [key], schema)
    return sinks.read_snapshot(spark, path, schema)


@query("upsert_dim_seller")
def _upsert_dim_seller(spark, sf):
    return _upsert(spark, Fixture(spark, sf).sellers, "seller_id", S.SELLERS)


@query("upsert_dim_product")
def _upsert_dim_product(spark, sf):
    return _upsert(spark, Fixture(spark, sf).products, "product_id", S.PRODUCTS)


@query("insert_absent_dim_date")
def _insert_absent_dim_date(spark, sf):
    rows = star.date_rows(Fixture(spark, sf).fact)
    path = shared_dir(spark, "dim_date")
    marked = rows.where(F.col("dt") < F.lit("1998-01-01").cast("date")).withColumn("year", F.lit(-1))
    sinks.write_snapshot(marked, path)
    sinks.insert_absent_table(spark, path, rows, "dt", S.DIM_DATE)
    return sinks.read_snapshot(spark, path, S.DIM_DATE)


@query("anomalies_with_id")
def _anomalies_with_id(spark, sf):
    fx = Fixture(spark, sf)
    return sinks.sequential_id(anomaly.detect_anomalies_all(fx.fact, fx.sellers), ["dt", "seller_id"])


@query("partition_row_count")
def _partition_row_count(spark, sf):
    fact = Fixture(spark, sf).fact
    path = shared_dir(spark, "fact_orders")
    sinks.replace_partitions(fact, path, _fact_dates(spark, sf), spread=["order_id"])
    ds = _ds_value(fact)
    return sinks.partition_row_count(spark, path, S.ORDERS, ds).select(F.lit(ds).alias("dt"), "n_rows")


# --- C: projections / filters ----------------------------------------------------------

def _landed_text(spark, sf, entity: str, frame: DataFrame, ds=None, spread=None) -> DataFrame:
    base = shared_dir(spark, "landing")
    n = len(_fact_dates(spark, sf)) + 1 if ds is None else 1
    landing.land(frame, base, entity, ds=ds, spread=spread, n_dates=n)
    return landing.read_raw(spark, base, entity, as_text=True)


def _misfiled_orders(spark, sf) -> DataFrame:
    """Raw orders; those of order keys divisible by 11 are filed one day late."""
    o = Fixture(spark, sf).raw_orders
    k = F.split("order_id", "-").getItem(0).cast("long")
    return o.withColumn("folder_dt", F.when(k % 11 == 0, F.date_add("dt", 1)).otherwise(F.col("dt")))


@query("stage_orders")
def _stage_orders(spark, sf):
    raw = _landed_text(spark, sf, "orders", _misfiled_orders(spark, sf), spread=["order_id"])
    good, _ = landing.stage(raw, "orders")
    return good


@query("stage_orders_rejects")
def _stage_orders_rejects(spark, sf):
    raw = _landed_text(spark, sf, "orders", _misfiled_orders(spark, sf), spread=["order_id"])
    _, bad = landing.stage(raw, "orders")
    return bad.groupBy("reject_reason").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("stage_sellers")
def _stage_sellers(spark, sf):
    fx = Fixture(spark, sf)
    good, _ = landing.stage(_landed_text(spark, sf, "sellers", fx.sellers, ds=_ds_value(fx.fact)), "sellers")
    return good


@query("stage_products")
def _stage_products(spark, sf):
    fx = Fixture(spark, sf)
    good, _ = landing.stage(_landed_text(spark, sf, "products", fx.products, ds=_ds_value(fx.fact)), "products")
    return good


@query("build_fact_orders")
def _build_fact_orders(spark, sf):
    fact = Fixture(spark, sf).fact
    return star.build_fact_orders(fact, _ds(fact))


@query("filter_valid_orders")
def _filter_valid_orders(spark, sf):
    return metrics.valid_orders(Fixture(spark, sf).fact)


@query("filter_date_range")
def _filter_date_range(spark, sf):
    fact = Fixture(spark, sf).fact
    ds = _ds(fact)
    return fact.where(F.col("dt").between(days_before(ds, S.MOVING_AVG_DAYS), ds))


@query("filter_invalid_status")
def _filter_invalid_status(spark, sf):
    return Fixture(spark, sf).orders_faulty.where(status_not_in("status"))


@query("filter_null_keys")
def _filter_null_keys(spark, sf):
    return Fixture(spark, sf).orders_faulty.where(F.col("order_id").isNull())


@query("filter_non_positive_amount")
def _filter_non_positive_amount(spark, sf):
    return Fixture(spark, sf).orders_faulty.where(F.col("total_amount") <= 0)


@query("param_query")
def _param_query(spark, sf):
    fact = Fixture(spark, sf).fact
    ds = _ds_value(fact)
    return spark.sql(
        "SELECT status, CAST(SUM(total_amount) AS DECIMAL(14,2)) AS revenue, "
        "CAST(COUNT(*) AS INT) AS nb_orders FROM {fact} "
        "WHERE dt BETWEEN :start AND :dt GROUP BY status",
        args={"start": days_before_value(ds, 6), "dt": ds}, fact=fact)


# --- D: joins ---------------------------------------------------------------------

@query("join_fact_seller")
def _join_fact_seller(spark, sf):
    fx = Fixture(spark, sf)
    return joins.join_fact_seller(fx.fact, fx.sellers).select(
        "order_id", "seller_id", "seller_name", "dt", "total_amount")


@query("join_fact_product")
def _join_fact_product(spark, sf):
    fx = Fixture(spark, sf)
    return joins.join_fact_product(fx.fact, fx.products).select(
        "order_id", "product_id", "category", "dt", "total_amount")


@query("anti_join_orphan_seller")
def _anti_join_orphan_seller(spark, sf):
    fx = Fixture(spark, sf)
    return joins.orphan_orders(fx.orders_faulty, fx.sellers)


@query("build_dim_customer")
def _build_dim_customer(spark, sf):
    fx = Fixture(spark, sf)
    current = fx.customers.where(_key_num("customer_id") % 4 == 0)
    return star.build_dim_customer(current, fx.fact)


# --- E: aggregations -------------------------------------------------------------

@query("agg_duplicate_count")
def _agg_duplicate_count(spark, sf):
    o = Fixture(spark, sf).raw_orders
    return o.agg((F.count(F.lit(1)) - F.count_distinct("order_id")).cast("bigint").alias("n_duplicates"))


@query("top_sellers")
def _top_sellers(spark, sf):
    fx = Fixture(spark, sf)
    return metrics.top_sellers(fx.fact, fx.sellers, fx.latest_dt)


@query("top_sellers_all")
def _top_sellers_all(spark, sf):
    fx = Fixture(spark, sf)
    return metrics.top_sellers(fx.fact, fx.sellers)


@query("daily_revenue_all")
def _daily_revenue_all(spark, sf):
    return metrics.daily_revenue_all(Fixture(spark, sf).fact)


@query("daily_revenue")
def _daily_revenue(spark, sf):
    fact = Fixture(spark, sf).fact
    return metrics.daily_revenue(fact, _ds(fact))


@query("daily_revenue_zero_filled")
def _daily_revenue_zero_filled(spark, sf):
    return metrics.daily_revenue_zero_filled(Fixture(spark, sf).fact)


@query("category_breakdown")
def _category_breakdown(spark, sf):
    fx = Fixture(spark, sf)
    return metrics.category_breakdown(fx.fact, fx.products, fx.latest_dt)


@query("category_breakdown_all")
def _category_breakdown_all(spark, sf):
    fx = Fixture(spark, sf)
    return metrics.category_breakdown(fx.fact, fx.products)


@query("customer_last_order")
def _customer_last_order(spark, sf):
    fact = Fixture(spark, sf).fact
    return metrics.customer_last_order(fact, _ds(fact))


@query("customer_activity")
def _customer_activity(spark, sf):
    fact = Fixture(spark, sf).fact
    return metrics.customer_activity(fact, _ds(fact))


@query("customer_activity_all")
def _customer_activity_all(spark, sf):
    return metrics.customer_activity_all(Fixture(spark, sf).fact)


@query("seller_daily_revenue")
def _seller_daily_revenue(spark, sf):
    d = metrics.seller_daily_revenue(Fixture(spark, sf).fact)
    return d.select("seller_id", "dt", F.col("revenue").cast(S.REVENUE).alias("revenue"))


# --- F / I: windows and scalars ----------------------------------------------------

@query("moving_avg_7d")
def _moving_avg_7d(spark, sf):
    return anomaly.moving_avg_7d(Fixture(spark, sf).fact)


@query("build_dim_date")
def _build_dim_date(spark, sf):
    return star.build_dim_date(None, Fixture(spark, sf).fact)


@query("date_window_bounds")
def _date_window_bounds(spark, sf):
    days = Fixture(spark, sf).fact.select("dt").distinct()
    return days.select("dt",
                       days_before(F.col("dt"), S.ACTIVE_WINDOW_DAYS).alias("active_from"),
                       days_before(F.col("dt"), S.MOVING_AVG_DAYS).alias("lookback_from"),
                       days_before(F.col("dt"), 6).alias("trend_from"))


@query("drop_pct")
def _drop_pct(spark, sf):
    win = anomaly.with_moving_window(metrics.seller_daily_revenue(Fixture(spark, sf).fact))
    return win.where(F.col("win_sum") > 0).select(
        "seller_id", "dt", drop_pct(F.col("win_sum"), F.col("win_n"), F.col("revenue"), 18).alias("drop_pct"))


# --- J: data quality -----------------------------------------------------------------

@query("dq_report")
def _dq_report(spark, sf):
    fx = Fixture(spark, sf)
    return quality.order_rule_report(fx.orders_faulty, fx.sellers)


def _one_rule(name: str) -> Query:
    def run(spark, sf):
        fx = Fixture(spark, sf)
        return quality.rule_frame(spark, quality.order_rules(fx.orders_faulty, fx.sellers, [name]))
    return run


for _name in quality.RULE_NAMES:
    QUERIES[f"dq_{_name}"] = _one_rule(_name)


@query("dq_rule_runner")
def _dq_rule_runner(spark, sf):
    fx = Fixture(spark, sf)
    return quality.rule_frame(spark, quality.order_rules(fx.orders_faulty, fx.sellers))


@query("check_primary_key")
def _check_primary_key(spark, sf):
    return quality.check_primary_key(Fixture(spark, sf).raw_orders, ["order_id"])


@query("dedup_orders")
def _dedup_orders(spark, sf):
    return quality.dedup(Fixture(spark, sf).raw_orders, ["order_id"],
                         ["product_id", "seller_id", "total_amount", "quantity", "status"])


@query("check_foreign_keys")
def _check_foreign_keys(spark, sf):
    fx = Fixture(spark, sf)
    fact = fx.fact
    dims = {
        "dim_seller": fx.sellers.where(_key_num("seller_id") % 10 != 0),
        "dim_product": fx.products.where(_key_num("product_id") % 10 != 0),
        "dim_customer": fx.customers.where(_key_num("customer_id") % 10 != 0),
        "dim_date": star.date_rows(fact).where(F.col("dt") >= F.lit("1996-01-01").cast("date")),
    }
    return quality.check_foreign_keys(fact, dims)


@query("check_domains")
def _check_domains(spark, sf):
    fx = Fixture(spark, sf)
    a = quality.check_domains(fx.sellers, varchar={"name": 15})
    b = quality.check_domains(fx.fact, numeric={"total_amount": (6, 2)})
    return a.unionByName(b)


# --- K: pipelines ----------------------------------------------------------------------

def _fact_dates(spark, sf) -> list:
    """The order dates, from the order headers that have a line (no dedup needed); one per calendar day."""
    return [r[0] for r in Fixture(spark, sf).order_dates.collect()]


def _landed(spark, sf) -> tuple[pipeline.Warehouse, list]:
    """A warehouse of its own per key: orders landed per date, sellers and
    products as a snapshot at the latest date."""
    fx, dates = Fixture(spark, sf), _fact_dates(spark, sf)
    wh = pipeline.Warehouse(shared_dir(spark, "warehouse"))
    landing.land(fx.fact, wh.raw(), "orders", spread=["order_id"], n_dates=len(dates))
    landing.land(fx.sellers, wh.raw(), "sellers", ds=max(dates))
    landing.land(fx.products, wh.raw(), "products", ds=max(dates))
    return wh, dates


@query("pipeline_ingest")
def _pipeline_ingest(spark, sf):
    wh, dates = _landed(spark, sf)
    pipeline.ingest(spark, wh, dates=dates)
    return pipeline.read_table(spark, wh, "staging", "orders")


@query("pipeline_star_fact")
def _pipeline_star_fact(spark, sf):
    wh, dates = _landed(spark, sf)
    pipeline.ingest(spark, wh, dates=dates)
    pipeline.build_star(spark, wh, dates=dates)
    return pipeline.read_table(spark, wh, "dwh", "fact_orders")


@query("pipeline_gate")
def _pipeline_gate(spark, sf):
    """K1 on the source's own rows, repeated order ids and all: the dates that
    pass the gate, with their staged rows."""
    fx, dates = Fixture(spark, sf), _fact_dates(spark, sf)
    wh = pipeline.Warehouse(shared_dir(spark, "warehouse"))
    landing.land(fx.raw_orders, wh.raw(), "orders", spread=["order_id"], n_dates=len(dates))
    landing.land(fx.sellers, wh.raw(), "sellers", ds=max(dates))
    landing.land(fx.products, wh.raw(), "products", ds=max(dates))
    pipeline.ingest(spark, wh, dates=dates)
    return pipeline.read_table(spark, wh, "staging", "orders").groupBy("dt").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


def _long_form(spark, wh) -> DataFrame:
    r = lambda t: pipeline.read_table(spark, wh, "analytics", t)
    ts = r("top_sellers").select(F.lit("top_sellers").alias("table_name"), "dt", F.col("seller_id").alias("key"),
                                 "revenue", F.col("nb_orders").alias("n"))
    dr = r("daily_revenue").select(F.lit("daily_revenue").alias("table_name"), "dt",
                                   F.lit(None).cast("string").alias("key"), "revenue", F.col("nb_orders").alias("n"))
    cb = r("category_breakdown").select(F.lit("category_breakdown").alias("table_name"), "dt",
                                        F.col("category").alias("key"), "revenue", F.col("nb_orders").alias("n"))
    ca = r("customer_activity").select(
        F.lit("customer_activity").alias("table_name"), "dt",
        F.explode(F.array(F.struct(F.lit("active").alias("key"), F.col("active_customers").alias("n")),
                          F.struct(F.lit("dormant").alias("key"), F.col("dormant_customers").alias("n")))).alias("e"))
    ca = ca.select("table_name", "dt", "e.key", F.lit(None).cast(S.REVENUE).alias("revenue"), "e.n")
    return ts.unionByName(dr).unionByName(cb).unionByName(ca)


@query("pipeline_aggregate")
def _pipeline_aggregate(spark, sf):
    wh, dates = _landed(spark, sf)
    pipeline.ingest(spark, wh, dates=dates)
    pipeline.build_star(spark, wh, dates=dates)
    pipeline.aggregate(spark, wh, dates=dates)
    return _long_form(spark, wh)


@query("anomalies")
def _anomalies(spark, sf):
    fx = Fixture(spark, sf)
    return anomaly.detect_anomalies(fx.fact, fx.sellers, fx.latest_dt)


@query("anomalies_all")
def _anomalies_all(spark, sf):
    fx = Fixture(spark, sf)
    return anomaly.detect_anomalies_all(fx.fact, fx.sellers)


@query("alert_events")
def _alert_events(spark, sf):
    fx = Fixture(spark, sf)
    return anomaly.alert_events(anomaly.detect_anomalies_all(fx.fact, fx.sellers))


@query("rerun_idempotent")
def _rerun_idempotent(spark, sf):
    """K6: a second run over all dates; every table, whole, against the first
    run's.  A table that differs in any row gets a row count of -1."""
    wh, dates = _landed(spark, sf)
    pipeline.backfill(spark, wh, dates)
    first = pipeline.table_contents(spark, wh)
    pipeline.backfill(spark, wh, dates)          # second run over the same dates
    return pipeline.same_summary(pipeline.table_summary(spark, wh), first, pipeline.table_contents(spark, wh))


# Fixed category -> family mapping of the enriched category dimension.
CATEGORY_FAMILY = [
    ("ECONOMY", "value"), ("LARGE", "bulk"), ("MEDIUM", "core"),
    ("PROMO", "value"), ("SMALL", "core"), ("STANDARD", "core"),
]


@query("dim_category")
def _dim_category(spark, sf):
    mapping = spark.createDataFrame(CATEGORY_FAMILY, "category string, family string")
    products = Fixture(spark, sf).products
    # The mapping is a fixed literal of 6 rows: a proven size bound.
    return products.join(F.broadcast(mapping), "category", "left").select(
        "product_id", "name", "category", "family")


# --- L: dashboard reads, from the published tables ---------------------------------------

def _published(table: str, read) -> Query:
    """Publish one analytics table for every date, with the dimensions it needs;
    then the dashboard's read of the latest date."""
    def run(spark, sf):
        fx, days = Fixture(spark, sf), [str(d) for d in _fact_dates(spark, sf)]
        wh = pipeline.Warehouse(shared_dir(spark, "warehouse"))
        tx = wh.store(spark).begin()
        for dim, rows, tables in (("dim_seller", fx.sellers, ("top_sellers", "anomalies")), ("dim_product", fx.products, ("category_breakdown",))):
            if table in tables:
                schema, keys = pipeline.KEYED_SCHEMAS[("dwh", dim)]
                tx.upsert(f"dwh/{dim}", rows, keys, schema)
        pipeline.publish(tx, table, fx.fact, days)
        tx.commit()
        return read(spark, wh, max(days))
    return run


QUERIES.update({
    "kpi_day": _published("daily_revenue", dashboard.kpi_day),
    "kpi_anomaly_count": _published("anomalies", dashboard.kpi_anomaly_count),
    "revenue_trend_7d": _published("daily_revenue", dashboard.revenue_trend),
    "top_10_sellers": _published("top_sellers", dashboard.top_sellers),
    "category_ranked": _published("category_breakdown", dashboard.categories_ranked),
    "category_domain": _published("category_breakdown", dashboard.category_domain),
    "active_ratio": _published("customer_activity", lambda spark, wh, _: dashboard.active_share(spark, wh)),
    "anomalies_ranked": _published("anomalies", dashboard.anomalies_ranked),
})


# --- M: streaming -----------------------------------------------------------------------

@query("stream_ingest")
def _stream_ingest(spark, sf):
    from souk.streaming.stream import run_incremental
    wh, _ = _landed(spark, sf)
    checkpoint = f"{wh.root}/_checkpoints/orders"
    run_incremental(spark, wh, checkpoint)
    run_incremental(spark, wh, checkpoint)   # nothing new: no batch, tables unchanged
    return pipeline.read_table(spark, wh, "analytics", "daily_revenue")
