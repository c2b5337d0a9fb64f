"""Stored tables and date-set jobs: failures, faults in the landing zone, arrival order."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from souk import schemas as S
from souk.operators import quality, sinks
from souk.plans import pipeline
from souk.session import shared_dir
from souk.sources import landing

D0 = dt.date(2024, 3, 1)


def day(k):
    return D0 + dt.timedelta(days=k)


def orders(spark, rows):
    """(order_id, seller, customer, day, amount, status)"""
    return spark.createDataFrame([(o, s, c, "p1", day(k), 1, Decimal(a), st) for o, s, c, k, a, st in rows], S.ORDERS)


def warehouse(spark, frame):
    wh = pipeline.Warehouse(shared_dir(spark, "wh"))
    landing.land(frame, wh.raw(), "orders")
    sellers = spark.createDataFrame([("s1", "one", "FR", None), ("s1", "uno", "FR", None), ("s2", "two", "DE", None)], S.SELLERS)
    products = spark.createDataFrame([("p1", "thing", "SMALL", Decimal("1.00"))], S.PRODUCTS)
    landing.land(sellers, wh.raw(), "sellers", ds=day(-1))
    landing.land(products, wh.raw(), "products", ds=day(-1))
    return wh


ROWS = [("a1", "s1", "c1", 0, "100", "completed"), ("a2", "s1", "c2", 1, "100", "completed"), ("a3", "s1", "c1", 3, "10", "completed"),
        ("a4", "s2", "c3", 3, "50", "cancelled"), ("a5", "s2", "c3", 4, "50", "completed")]


def tables(spark, wh):
    names = ["top_sellers", "daily_revenue", "category_breakdown", "customer_activity", "anomalies", "alerts"]
    return {t: sorted(map(str, pipeline.read_table(spark, wh, "analytics", t).collect())) for t in names}


def test_sequential_id_loses_nothing_on_many_partitions(spark):
    n = 200_000
    df = spark.range(0, n, 1, 23).select((F.col("id") * 7919 % n).alias("k"), F.repeat(F.col("id").cast("string"), 20).alias("wide"))
    out = sinks.sequential_id(df, ["k"])
    row = out.agg(F.count("*"), F.count_distinct("id"), F.min("id"), F.max("id"), F.count_if(F.col("id") != F.col("k") + 1)).first()
    assert tuple(row) == (n, n, 1, n, 0)


def test_failed_replace_leaves_the_old_rows(spark):
    path = shared_dir(spark, "t")
    df = spark.createDataFrame([(D0, Decimal("1.00"), 1)], S.DAILY_REVENUE)
    sinks.replace_partitions(df, path, [D0])
    broken = df.withColumn("nb_orders", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        sinks.replace_partition(broken, path, D0)
    assert [r.nb_orders for r in sinks.read_partitioned(spark, path, S.DAILY_REVENUE).collect()] == [1]
    sinks.replace_partitions(df.where("false"), path, [D0, day(1)])
    assert sinks.read_partitioned(spark, path, S.DAILY_REVENUE).count() == 0
    assert sinks.vacuum(spark, path) >= 1


def test_backfill_equals_daily_runs_in_any_order(spark):
    days = [day(k) for k in range(5)]                 # day 2 has no order
    frame = orders(spark, ROWS)
    whole = warehouse(spark, frame)
    got = pipeline.backfill(spark, whole, days)
    assert got["failed"] == {} and got["fact_rows"] == 5 and got["anomalies"] == 1
    want = tables(spark, whole)
    assert len(want["daily_revenue"]) == 5 and len(want["customer_activity"]) == 5
    assert sum("uno" in r for r in want["top_sellers"]) == 3 and not any("one" in r for r in want["top_sellers"])
    daily = warehouse(spark, frame)
    for d in (days[3], days[0], days[4], days[2], days[1]):
        pipeline.run_day(spark, daily, d)
    assert tables(spark, daily) == want


def test_gate_judges_each_date_alone(spark):
    bad = ROWS + [("b1", "s1", "c1", 1, "-5", "completed"), ("a1", "s1", "c1", 4, "7", "completed")]
    wh = warehouse(spark, orders(spark, bad))
    got = pipeline.backfill(spark, wh, [day(k) for k in range(5)])
    assert sorted(got["failed"]) == [str(day(1)), str(day(4))]
    assert "positive_amount" in got["failed"][str(day(1))][0] and "another_date" in got["failed"][str(day(4))][0]
    assert {str(r.dt) for r in pipeline.read_table(spark, wh, "staging", "orders").collect()} == {str(day(0)), str(day(3))}
    with pytest.raises(quality.DataQualityError):
        pipeline.run_day(spark, wh, day(1))


def test_staged_rows_and_rejects_are_all_landed_records(spark, tmp_path):
    folder = tmp_path / "orders" / f"folder_dt={D0}"
    folder.mkdir(parents=True)
    good = ('{"order_id":"o%d","seller_id":"s1","customer_id":"c","product_id":"p1","dt":"2024-03-01",'
            '"quantity":1,"total_amount":2.5,"status":"completed"}')
    lines = [good % 1, good % 2, (good % 3).replace('"dt":"2024-03-01",', ""), (good % 4).replace("2.5", '"x"'), "{not json",
             (good % 5).replace("2024-03-01", "2024-03-02")]
    (folder / "part.json").write_text("\n".join(lines))
    staged, rejects = landing.stage(landing.read_raw(spark, str(tmp_path), "orders", as_text=True), "orders")
    assert sorted(r.order_id for r in staged.collect()) == ["o1", "o2"]
    assert sorted(r.reject_reason for r in rejects.collect()) == ["bad total_amount", "dt differs from folder", "dt differs from folder", "not a record"]


def test_array_files_under_dt_folders(spark, tmp_path):
    folder = tmp_path / "orders" / f"dt={D0}"
    folder.mkdir(parents=True)
    (folder / "orders.json").write_text('[{"order_id": "o1", "dt": "2024-03-01", "quantity": 2, "total_amount": 1.5}]')
    raw = landing.read_raw(spark, str(tmp_path), "orders", ds=D0, as_text=True, layout=landing.Layout(multiline=True, folder="dt"))
    staged, rejects = landing.stage(raw, "orders")
    assert [(r.order_id, r.dt) for r in staged.collect()] == [("o1", D0)] and rejects.count() == 0


def test_empty_warehouse_has_no_latest_date(spark):
    wh = pipeline.Warehouse(shared_dir(spark, "wh"))
    for job in (pipeline.build_star, pipeline.aggregate, pipeline.detect):
        with pytest.raises(pipeline.EmptySourceError):
            job(spark, wh)


def test_one_day_detection_opens_only_its_look_back(spark):
    wh = warehouse(spark, orders(spark, ROWS))
    for k in range(5):                                # a run per date
        pipeline.ingest(spark, wh, dates=[day(k)], gate=False)
        pipeline.build_star(spark, wh, dates=[day(k)])
    read = pipeline.read_table(spark, wh, "dwh", "fact_orders", dates=[day(3)])
    every = pipeline.read_table(spark, wh, "dwh", "fact_orders")
    assert 0 < len(read.inputFiles()) < len(every.inputFiles())
    assert {str(r.dt) for f in read.inputFiles() for r in spark.read.parquet(f).select("dt").collect()} == {str(day(3))}
