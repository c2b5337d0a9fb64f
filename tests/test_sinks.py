"""Writes: partition replace (incl. empty), upsert, insert-absent, ids, landing zone."""

import datetime as dt
import gzip
from decimal import Decimal

from pyspark.sql import functions as F

from souk import schemas as S
from souk.operators import sinks
from souk.session import shared_dir
from souk.sources import landing


def _daily(spark, rows):
    return spark.createDataFrame([(d, Decimal(r), n) for d, r, n in rows], S.DAILY_REVENUE)


def test_replace_partition_idempotent_and_empty(spark):
    path = shared_dir(spark, "t")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    df = _daily(spark, [(d1, "1.00", 1), (d2, "2.00", 2)])
    for _ in range(2):
        sinks.replace_partitions(df, path, [d1, d2])
    assert sinks.read_partitioned(spark, path, S.DAILY_REVENUE).count() == 2
    sinks.replace_partition(df.limit(0), path, d2)
    assert [r["dt"] for r in sinks.read_partitioned(spark, path, S.DAILY_REVENUE).collect()] == [d1]
    sinks.replace_partitions(df.where(F.col("dt") == d1), path, [d1, d2])   # d2 requested, empty
    assert [r["dt"] for r in sinks.read_partitioned(spark, path, S.DAILY_REVENUE).collect()] == [d1]


def test_upsert_changed_new_and_kept(spark):
    path = shared_dir(spark, "dim")
    target = spark.createDataFrame([("1", "a", "FR", None), ("2", "b", "FR", None)], S.SELLERS)
    source = spark.createDataFrame([("2", "B", "DE", None), ("3", "c", "IT", None)], S.SELLERS)
    sinks.write_snapshot(target, path)
    sinks.upsert_table(spark, path, source, ["seller_id"], S.SELLERS)
    got = {r["seller_id"]: (r["name"], r["country"]) for r in sinks.read_snapshot(spark, path, S.SELLERS).collect()}
    assert got == {"1": ("a", "FR"), "2": ("B", "DE"), "3": ("c", "IT")}
    assert sinks.current_version(spark, path) == 2


def test_insert_absent_keeps_existing(spark):
    t = spark.createDataFrame([(dt.date(2024, 1, 1), -1, 1, 1)], S.DIM_DATE)
    s = spark.createDataFrame([(dt.date(2024, 1, 1), 2024, 1, 1), (dt.date(2024, 1, 2), 2024, 1, 2)], S.DIM_DATE)
    got = {r["dt"]: r["year"] for r in sinks.insert_absent(t, s, "dt").collect()}
    assert got == {dt.date(2024, 1, 1): -1, dt.date(2024, 1, 2): 2024}


def test_sequential_id_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") % 37).alias("a"), (F.col("id") * 7 % 1001).alias("b")).distinct()
    out = sinks.sequential_id(df, ["a", "b"]).orderBy("a", "b").collect()
    assert [r["id"] for r in out] == list(range(1, len(out) + 1))


def test_landing_roundtrip_and_misfiled_reject(spark):
    base = shared_dir(spark, "landing")
    d = dt.date(2024, 1, 5)
    rows = [("o1", "s1", "c1", "p1", d, 2, Decimal("10.26"), "completed"),
            ("o2", "s1", "c1", "p1", d, 1, Decimal("3.00"), "pending")]
    df = spark.createDataFrame(rows, S.ORDERS)
    df = df.withColumn("folder_dt", F.when(F.col("order_id") == "o2", F.date_add("dt", 1)).otherwise(F.col("dt")))
    landing.land(df, base, "orders")
    good, bad = landing.stage(landing.read_raw(spark, base, "orders", as_text=True), "orders")
    assert [r["order_id"] for r in good.collect()] == ["o1"]
    assert [r["reject_reason"] for r in bad.collect()] == ["dt differs from folder"]
    one_day = landing.read_raw(spark, base, "orders", ds=d)
    assert one_day.count() == 1


def test_malformed_field_rejected(spark):
    raw = spark.createDataFrame([("o1", "s1", "c1", "p1", "2024-01-05", "x", "1.00", "completed", dt.date(2024, 1, 5))],
                                "order_id string, seller_id string, customer_id string, product_id string, dt string, "
                                "quantity string, total_amount string, status string, path_dt date")
    good, bad = landing.stage(raw, "orders")
    assert good.count() == 0 and bad.collect()[0]["reject_reason"] == "bad quantity"


def test_multiline_array_file(spark, tmp_path):
    folder = tmp_path / "orders" / "folder_dt=2024-01-05"
    folder.mkdir(parents=True)
    (folder / "orders.json").write_text(
        '[\n {"order_id": "o1", "seller_id": "s1", "customer_id": "c1", "product_id": "p1",\n'
        '  "dt": "2024-01-05", "quantity": 1, "total_amount": 10.255, "status": "completed"}\n]\n')
    df = landing.read_raw(spark, str(tmp_path), "orders", multiline=True)
    r = df.collect()[0]
    assert r["order_id"] == "o1" and r["total_amount"] == Decimal("10.26")


def test_sequential_id_descending_order(spark):
    df = spark.range(0, 3000).select((F.col("id") % 50).alias("v"), F.col("id").alias("k"))
    out = sinks.sequential_id(df, [F.desc("v"), F.asc("k")], "rank_no").collect()
    got = sorted((r["rank_no"], -r["v"], r["k"]) for r in out)
    assert [g[0] for g in got] == list(range(1, 3001))
    assert [g[1:] for g in got] == sorted(g[1:] for g in got)


def test_landed_json_is_compressed_and_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "RECORDS_PER_FILE", 40)
    day = dt.date(2024, 3, 1)
    rows = [(f"o{k}", "s1", "c1", "p1", day, 1, Decimal("2.50"), "completed") for k in range(300)]
    base = str(tmp_path / "raw")
    landing.land(spark.createDataFrame(rows, S.ORDERS).coalesce(1), base, "orders", spread=["order_id"], n_dates=1)
    files = list((tmp_path / "raw" / "orders" / f"folder_dt={day}").glob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert all(len(gzip.open(f).read().splitlines()) <= 40 for f in files)
    assert sorted(map(tuple, landing.read_raw(spark, base, "orders").select(*S.ORDER_COLUMNS).collect())) == sorted(rows)
