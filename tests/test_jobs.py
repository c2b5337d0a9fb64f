"""Jobs on stored state: activity, key index, gates, ids, quarantine, dashboard, late files."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from souk import schemas as S
from souk.operators import activity, metrics, quality
from souk.operators.store import Store, Transaction
from souk.plans import dashboard, pipeline
from souk.session import shared_dir
from souk.sources import landing
from souk.streaming import stream
from souk.streaming.stream import run_incremental, touched_dates
from test_warehouse import ROWS, day, orders, tables, warehouse


def test_activity_state_equals_the_full_form_in_any_order(spark):
    rng = random.Random(11)
    held: dict[int, set] = {}
    store = Store(spark, shared_dir(spark, "wh"))
    for step in range(7):
        days = rng.sample(range(0, 160, 4), 5) if step else [0, 4, 80]
        for k in days:                      # a rerun takes customers away and adds others; some days become empty
            held[k] = {rng.choice(["a", "b", "c", "d", "e", None]) for _ in range(rng.randint(0, 4))}
        frame = orders(spark, [(f"{k}-{c}", "s1", c, k, "1", "completed") for k in days for c in held[k]])
        tx = store.begin()
        activity.update(tx, frame, [str(day(k)) for k in days])
        tx.commit()
        every = orders(spark, [(f"{k}-{c}", "s1", c, k, "1", "completed") for k, cs in held.items() for c in cs])
        spine = spark.createDataFrame([(day(k),) for k in held], "dt date")
        want = sorted(map(tuple, metrics.customer_activity_all(every, dates=spine).collect()))
        tx = store.begin()
        got = sorted(map(tuple, tx.read(activity.ACTIVITY, S.CUSTOMER_ACTIVITY, None, "dt").collect()))
        assert got == want
        last = {r.customer_id: r.last_order_dt for r in metrics.customer_last_order(every, day(999)).collect()}
        assert {r.customer_id: r.last_order_dt for r in activity.last_orders(tx).collect()} == last


def _land(spark, wh, rows):
    landing.land(orders(spark, rows), wh.raw(), "orders")


def test_key_index_opens_few_files_and_knows_replaced_dates(spark, monkeypatch):
    wh = warehouse(spark, orders(spark, [(f"o{k}", "s1", "c1", k, "1", "completed") for k in range(14)]))
    opened, read = [], pipeline.Transaction.read_keyed

    def watched(self, name, *args, **kw):
        df = read(self, name, *args, **kw)
        if name == pipeline.KEYS:
            opened.append(len(df.inputFiles()))
        return df
    monkeypatch.setattr(pipeline.Transaction, "read_keyed", watched)
    monkeypatch.setattr("souk.operators.store.MAX_LAYERS", 4)
    for k in range(14):
        pipeline.ingest(spark, wh, ds=day(k))
    assert max(opened[-4:]) <= max(opened[4:8]) + 1 and max(opened) <= 6
    _land(spark, wh, [("o3", "s1", "c1", 20, "1", "completed")])
    with pytest.raises(quality.DataQualityError, match="another_date"):
        pipeline.ingest(spark, wh, ds=day(20))
    _land(spark, wh, [("p3", "s1", "c1", 3, "1", "completed")])        # day 3 gives its id free
    pipeline.ingest(spark, wh, ds=day(3))
    pipeline.ingest(spark, wh, ds=day(20))
    assert pipeline.read_table(spark, wh, "staging", "orders", day(20)).count() == 1


def test_gates_stop_only_their_date(spark):
    rows = ROWS + [("x" * 41, "s1", "c1", 0, "1", "completed")]
    wh = warehouse(spark, orders(spark, rows))
    landing.land(orders(spark, [("q1", "s1", "c9", 6, "1", "completed")]).withColumn("product_id", F.lit("nope")), wh.raw(), "orders")
    got = pipeline.backfill(spark, wh, [day(k) for k in (0, 1, 3, 4, 6)])
    assert sorted(got["failed"]) == [str(day(0)), str(day(6))]
    assert "varchar(40)" in got["failed"][str(day(0))][0] and "dim_product" in got["failed"][str(day(6))][0]
    fact = pipeline.read_table(spark, wh, "dwh", "fact_orders")
    assert {str(r.dt) for r in fact.collect()} == {str(day(k)) for k in (1, 3, 4)}
    assert "c9" not in {r.customer_id for r in pipeline.read_table(spark, wh, "dwh", "dim_customer").collect()}
    with pytest.raises(quality.DataQualityError, match="dim_product"):
        pipeline.build_star(spark, wh, ds=day(6))


def test_foreign_key_report(spark):
    fact = orders(spark, [("1", "s1", "c1", 0, "1", "completed"), ("2", "s9", "c1", 0, "1", "completed"), ("3", "s9", None, 1, "1", "completed"),
                          ("4", None, "c1", 1, "1", "completed"), ("5", "s8", "c2", 1, "1", "completed")])
    dims = {"dim_seller": spark.createDataFrame([("s1",), (None,)], "seller_id string"),
            "dim_product": spark.createDataFrame([("p1",)], "product_id string"),
            "dim_customer": spark.createDataFrame([("c1",)], "customer_id string"),
            "dim_date": spark.createDataFrame([(day(0),)], "dt date")}
    got = {(str(r.dt), r.name): r.actual for r in quality.foreign_key_report_by_date(fact, dims).collect()}
    assert got == {(str(day(0)), "seller_id:dim_seller"): 1, (str(day(1)), "seller_id:dim_seller"): 2,
                   (str(day(1)), "customer_id:dim_customer"): 1, (str(day(1)), "dt:dim_date"): 1}


def test_anomaly_ids_are_stable(spark):
    drop = [(f"h{s}{k}", s, "c1", k, "100", "completed") for s in ("s1", "s2") for k in range(3)]
    wh = warehouse(spark, orders(spark, drop + [("z1", "s1", "c1", 3, "10", "completed"), ("z2", "s2", "c1", 3, "20", "completed")]))
    pipeline.backfill(spark, wh, [day(k) for k in range(4)])
    first = {r.seller_id: (r.id, r.detected_at, r.revenue) for r in pipeline.stored_anomalies(spark, wh).collect()}
    assert sorted(v[0] for v in first.values()) == [1, 2]
    pipeline.run_day(spark, wh, day(3))
    assert {r.seller_id: (r.id, r.detected_at, r.revenue) for r in pipeline.stored_anomalies(spark, wh).collect()} == first
    _land(spark, wh, [("z1", "s1", "c1", 3, "11", "completed"), ("z2", "s2", "c1", 3, "20", "completed")])
    pipeline.run_day(spark, wh, day(3))
    now = {r.seller_id: (r.id, r.detected_at, r.revenue) for r in pipeline.stored_anomalies(spark, wh, [day(3)]).collect()}
    assert now["s2"] == first["s2"] and now["s1"][0] == 3 and now["s1"][2] == Decimal("11.00")


def test_quarantine_and_replay_exactly_once(spark):
    wh = warehouse(spark, orders(spark, ROWS))
    folder = f"{wh.raw()}/orders/folder_dt={day(0)}"
    bad = '{"order_id":"r1","seller_id":"s1","customer_id":"c5","product_id":"p1","dt":"%s","quantity":"x","total_amount":"5","status":"completed"}' % day(0)
    with open(f"{folder}/part-bad.json", "w") as f:
        f.write(bad + "\n")
    pipeline.backfill(spark, wh, [day(k) for k in range(5)])
    held = pipeline.read_table(spark, wh, "staging", "rejects_orders").collect()
    assert [(str(r.dt), r.reject_reason, "part-bad" in r.source_file) for r in held] == [(str(day(0)), "bad quantity", True)]
    fixed = spark.createDataFrame([(day(0), held[0].raw, bad.replace('"x"', "3")), (day(1), "not held", bad)], "dt date, raw string, record string")
    assert pipeline.replay(spark, wh, fixed)["published"] == [str(day(0))]
    once = {r.order_id: r.quantity for r in pipeline.read_table(spark, wh, "dwh", "fact_orders", day(0)).collect()}
    assert once == {"a1": 1, "r1": 3} and pipeline.read_table(spark, wh, "staging", "rejects_orders").count() == 0
    assert pipeline.replay(spark, wh, fixed)["published"] == []
    pipeline.run_day(spark, wh, day(0))                                   # the repair holds for later ingests
    assert {r.order_id: r.quantity for r in pipeline.read_table(spark, wh, "dwh", "fact_orders", day(0)).collect()} == once


def test_dashboard_opens_only_published_files_of_its_dates(spark):
    wh = warehouse(spark, orders(spark, ROWS))
    for k in (0, 1, 3, 4):
        pipeline.run_day(spark, wh, day(k))
    whole = pipeline.read_table(spark, wh, "analytics", "daily_revenue")
    for read in (dashboard.kpi_day, dashboard.top_sellers, dashboard.categories_ranked, dashboard.category_domain, dashboard.kpi_anomaly_count):
        files = read(spark, wh, day(3)).inputFiles()
        assert len(files) <= 1 and all("/analytics/" in f for f in files)
    assert len(dashboard.revenue_trend(spark, wh, day(1)).inputFiles()) < len(whole.inputFiles())
    assert [(r.rank_no, str(r.dt)) for r in dashboard.revenue_trend(spark, wh, day(3)).collect()] == [(1, str(day(0))), (2, str(day(1))), (3, str(day(3)))]
    assert dashboard.dates(spark, wh)[0] == str(day(4)) and dashboard.kpi_day(spark, wh).first().dt == day(4)
    assert [r.seller_id for r in dashboard.anomalies_ranked(spark, wh, day(3)).collect()] == ["s1"]


def test_an_older_snapshot_only_adds_keys(spark):
    wh = warehouse(spark, orders(spark, ROWS))
    pipeline.run_day(spark, wh, day(4))
    newer = spark.createDataFrame([("s1", "new", "FR", None)], S.SELLERS)
    landing.land(newer, wh.raw(), "sellers", ds=day(3))
    assert touched_dates(spark, wh, [("sellers", str(day(3)))]) == [str(day(3)), str(day(4))]
    assert touched_dates(spark, wh, [("sellers", str(day(-1))), ("orders", str(day(9)))]) == [str(day(0)), str(day(1)), str(day(9))]
    pipeline.run_day(spark, wh, day(4))
    pipeline.run_day(spark, wh, day(0))                                   # sees the first snapshot only
    names = {r.seller_id: r.name for r in pipeline.read_table(spark, wh, "staging", "sellers").collect()}
    assert names["s1"] == "new" and names["s2"] == "two"


def test_a_job_meeting_another_writer_runs_again(spark):
    wh = warehouse(spark, orders(spark, ROWS))
    pipeline.ingest(spark, wh, ds=day(0))
    runs = []

    def job(tx):
        tx.parts(pipeline.ORDERS)
        runs.append(1)
        if len(runs) == 1:
            pipeline.ingest(spark, wh, ds=day(1))
        tx.set_prop(pipeline.ORDERS, "seen", len(tx.parts(pipeline.ORDERS)))
    pipeline.in_commit(spark, wh, job)
    assert len(runs) == 2 and wh.store(spark).begin().prop(pipeline.ORDERS, "seen") == 2
    assert len(tables(spark, wh)) == 6


def test_late_files_of_any_entity_refresh_their_dates(spark):
    wh = warehouse(spark, orders(spark, ROWS))
    checkpoint = f"{wh.root}/_checkpoints/landed"
    assert run_incremental(spark, wh, checkpoint) == 1
    assert {r.seller_name for r in pipeline.read_table(spark, wh, "analytics", "top_sellers").collect()} == {"uno", "two"}
    landing.land(spark.createDataFrame([("s1", "late", "FR", None), ("s2", "x" * 201, "DE", None)], S.SELLERS), wh.raw(), "sellers", ds=day(3))
    assert run_incremental(spark, wh, checkpoint) == 1
    names = {(str(r.dt), r.seller_name) for r in pipeline.read_table(spark, wh, "analytics", "top_sellers").collect()}
    assert names == {(str(day(0)), "uno"), (str(day(1)), "uno"), (str(day(3)), "late"), (str(day(4)), "two")}
    rejects = pipeline.read_table(spark, wh, "staging", "rejects_sellers").collect()
    assert [(str(r.dt), r.reject_reason) for r in rejects] == [(str(day(3)), "name longer than 200")]
    before = wh.store(spark).state()["seq"]
    assert run_incremental(spark, wh, checkpoint) == 0 and wh.store(spark).state()["seq"] == before
    want = tables(spark, wh)
    stream.process_batch(spark, wh, spark.createDataFrame([("sellers", day(3))], "entity string, dt date"))       # a replayed batch
    assert tables(spark, wh) == want


GATED = [("a", "s1", "c1", 0, "1", "completed"), ("a", "s1", "c1", 0, "1", "completed"), ("a", "s9", "c1", 1, "1", "completed"),
         (None, "s1", "c1", 1, "1", "completed"), (None, None, "c1", 1, "-1", "lost"), ("b", "s2", "c1", 2, "1", "completed"),
         ("e", "s2", "c1", 2, "1", "completed"), ("e", "s8", "c1", 2, "0", None), ("b", "s1", "c1", 3, "1", "completed"), ("d", "s1", "c1", 4, "1", "completed")]


def test_report_by_date_is_the_report_of_each_date(spark):
    frame, sellers = orders(spark, GATED), spark.createDataFrame([("s1",), ("s2",), (None,)], "seller_id string")
    got = {(str(r.dt), r.name): r.actual for r in quality.order_rule_report_by_date(frame, sellers).collect()}
    want = {(str(day(k)), r.name): r.actual for k in range(5) for r in quality.order_rule_report(frame, sellers, day(k)).collect()}
    assert got == want
    assert quality.unknown_keys(frame, {"seller_id": (sellers, "seller_id")}).count() == 2
    assert quality.unknown_keys(frame.where("seller_id < 's3'"), {"seller_id": (sellers, "seller_id")}) is None


def test_repeated_ids_are_those_of_brute_force(spark):
    wh = warehouse(spark, orders(spark, [("d", "s1", "c1", 9, "1", "completed"), ("x", "s1", "c1", 9, "1", "completed")]))
    pipeline.ingest(spark, wh, ds=day(9))
    frame = orders(spark, GATED)
    got = pipeline._repeated_ids(wh.store(spark).begin(), frame, [str(day(k)) for k in range(5)])
    assert {(str(r.dt), r.order_id, r.n, r.old, str(r.first)) for r in got.collect()} == {
        (str(day(0)), "a", 2, False, str(day(0))), (str(day(1)), "a", 1, False, str(day(0))), (str(day(2)), "b", 1, False, str(day(2))),
        (str(day(3)), "b", 1, False, str(day(2))), (str(day(2)), "e", 2, False, str(day(2))), (str(day(4)), "d", 1, True, str(day(4)))}
    assert {str(r.dt): r.actual for r in pipeline._reused_ids(got).collect()} == {str(day(k)): 1 for k in (1, 3, 4)}


def test_a_run_keeps_the_text_of_rejects_only_and_copies_files_as_they_lie(spark, monkeypatch):
    wh = warehouse(spark, orders(spark, ROWS))
    with open(f"{wh.raw().removeprefix('file:')}/orders/folder_dt={day(0)}/part-bad.json", "w") as f:
        f.write("not json")
    clustered, write = {}, Transaction._write

    def watched(self, name, df, part, sort, *args):
        clustered[name] = bool(args and args[0])
        return write(self, name, df, part, sort, *args)
    monkeypatch.setattr(Transaction, "_write", watched)
    out = pipeline.ingest(spark, wh, dates=[day(k) for k in range(5)])
    pipeline.build_star(spark, wh, dates=[day(k) for k in range(5)])
    texts = spark.read.parquet(out["run"]).groupBy("rejected").agg(F.count("raw").alias("n")).collect()
    assert {str(r.rejected).lower(): r.n for r in texts} == {"false": 0, "true": 1}
    assert clustered["staging/orders"] and clustered["dwh/fact_orders"] and not clustered["staging/order_keys"]
    fact = pipeline.read_table(spark, wh, "dwh", "fact_orders", dates=[day(3)])
    assert sorted(r.order_id for r in fact.collect()) == ["a3", "a4"]


def test_activity_of_new_dates_holds_nothing_against_the_state(spark, monkeypatch):
    stored, keep = [], activity._stored
    monkeypatch.setattr(activity, "_stored", lambda df, name: stored.append(name) or keep(df, name))
    store = Store(spark, shared_dir(spark, "wh"))
    for days, again in (([0, 3], False), ([5], False), ([3, 5], True)):
        del stored[:]
        tx = store.begin()
        activity.update(tx, orders(spark, [(f"{k}", "s1", f"c{k % 2}", k, "1", "completed") for k in days]), [str(day(k)) for k in days])
        tx.commit()
        assert ("activity-changed" in stored) == again
    every = orders(spark, [(f"{k}", "s1", f"c{k % 2}", k, "1", "completed") for k in (0, 3, 5)])
    got = store.begin().read(activity.ACTIVITY, S.CUSTOMER_ACTIVITY, None, "dt").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, metrics.customer_activity_all(every).collect()))


def test_ids_of_several_dates_are_picked_before_they_are_counted_by_date(spark):
    frame = orders(spark, [(f"{k % 50}-1", "s1", "c", k // 50, "1", "completed") for k in range(100)] + [(f"x{k}", "s1", "c", 3, "1", "completed") for k in range(40)])
    got = pipeline._repeated_ids(Store(spark, shared_dir(spark, "wh")).begin(), frame, [str(day(k)) for k in (0, 1, 3)])
    assert sorted((r.dt, r.order_id, r.n, r.first) for r in got.collect()) == sorted((day(d), f"{k}-1", 1, day(0)) for k in range(50) for d in (0, 1))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Join") and "Aggregate" not in plan[plan.index("Join"):]


def test_only_dates_that_differ_are_compared_row_by_row(spark, monkeypatch):
    rows = [(day(i % 6), str(i), None if i % 3 else str(i), Decimal(i)) for i in range(90)]
    schema = "dt date, a string, b string, n decimal(12,2)"
    table = spark.createDataFrame(rows, schema)
    changed = {
        "less": rows[:-1], "twice": rows + rows[4:5], "value": rows[:-1] + [(*rows[-1][:3], Decimal("89.01"))],
        "null": rows[:3] + [(*rows[3][:2], None, rows[3][3])] + rows[4:], "date": rows[:-1] + [(day(0), *rows[-1][1:])],
        "swapped": rows[:1] + [(rows[1][0], None, rows[1][1], rows[1][3])] + rows[2:], "none": [], "no date": rows + [(None, "n", None, None)],
    }
    before = {"same": table, **{t: table for t in changed}}
    after = {"same": table.repartition(5), **{t: spark.createDataFrame(r, schema) for t, r in changed.items()}}
    held, compared = pipeline.differing_rows, []
    monkeypatch.setattr(pipeline, "differing_rows", lambda x, y: compared.append(x.count()) or held(x, y))
    summary = spark.createDataFrame([(t, 90, None) for t in before], "table_name string, n_rows long, revenue decimal(18,2)")
    got = {r.table_name: r.n_rows for r in pipeline.same_summary(summary, before, after).collect()}
    assert got == {"same": 90, **{t: -1 for t in changed}}
    assert compared == [0, 15, 15, 15, 15, 30, 15, 90, 0]         # rows of the dates that differ
