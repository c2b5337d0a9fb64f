"""Physical-plan properties of the flagship query."""

import io
from contextlib import redirect_stdout

import __spark_entry__ as entry


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_flagship_prunes_columns_and_pre_aggregates(spark):
    plan = _plan(entry.queries()["anomalies_all"](spark, "/root/testdata/sf0.001"))
    line_scans = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema: struct<l_orderkey")]
    assert line_scans, plan
    for ln in line_scans:
        for unused in ("l_discount", "l_tax", "l_shipdate"):
            assert unused not in ln
    # partial aggregation happens before the shuffle of the seller-day revenue
    assert "partial_sum" in plan
    # the moving window is a RANGE frame per seller
    assert "RangeFrame" in plan or "rangebetween" in plan.lower()
