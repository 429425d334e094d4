"""Report semantics on tiny hand-built tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from costframe.plans import reports as rp

BILL = ("service struct<id:string,description:string>, sku struct<id:string,description:string>, "
        "project struct<id:string,number:string>, cost_at_list double, "
        "cost_at_effective_price_default double, cost double, cost_type string, "
        "usage_start_time timestamp_ntz, credits array<struct<type:string,amount:double>>")


def row(svc, ts, cost=10.0, cost_type="regular", eff=None, lst=None, credits=None, project=("p1", "101"),
        sku="s"):
    return ((svc, svc), (sku, sku), project, lst if lst is not None else cost, eff, cost, cost_type,
            dt.datetime.fromisoformat(ts), credits)


def breakdown(spark, rows, as_of=dt.date(1998, 8, 19), **kw):
    df = spark.createDataFrame(rows, BILL)
    return {r["Service Description"]: r for r in rp.cost_breakdown(df, as_of, **kw).collect()}


def test_null_and_case_in_cost_type(spark):
    out = breakdown(spark, [row("A", "1998-08-02 00:00:00", cost_type=None),
                            row("A", "1998-08-02 00:00:00", cost_type="Tax"),
                            row("A", "1998-08-02 00:00:00", cost_type="tax"),
                            row("A", "1998-08-02 00:00:00", cost_type="adjustment")])
    # NULL is dropped by != (three-valued), 'Tax' is not 'tax' and stays
    assert out["A"].Subtotal == Decimal("10.000000000")


def test_summer_month_edges(spark):
    rows = [row("A", "1998-07-31 22:59:59", cost=1.0), row("A", "1998-07-31 23:00:00", cost=2.0),
            row("A", "1998-08-31 22:59:59", cost=4.0), row("A", "1998-08-31 23:00:00", cost=8.0)]
    assert breakdown(spark, rows)["A"].Subtotal == Decimal("6.000000000")


def test_march_short_october_long(spark):
    # Clocks go forward on 29 March 1998 and back on 25 October 1998.
    mar = [row("A", "1998-02-28 23:59:59", cost=1.0), row("A", "1998-03-01 00:00:00", cost=2.0),
           row("A", "1998-03-31 22:59:59", cost=4.0), row("A", "1998-03-31 23:00:00", cost=8.0)]
    assert breakdown(spark, mar, dt.date(1998, 3, 15))["A"].Subtotal == Decimal("6.000000000")
    octo = [row("A", "1998-09-30 22:59:59", cost=1.0), row("A", "1998-09-30 23:00:00", cost=2.0),
            row("A", "1998-10-31 23:59:59", cost=4.0), row("A", "1998-11-01 00:00:00", cost=8.0)]
    assert breakdown(spark, octo, dt.date(1998, 10, 15))["A"].Subtotal == Decimal("6.000000000")


def test_savings_arithmetic_and_unlisted_credits(spark):
    credits = [("COMMITTED_USAGE_DISCOUNT", -1.5), ("PROMOTION", -0.25), ("SOMETHING_ELSE", -100.0)]
    out = breakdown(spark, [row("A", "1998-08-02 00:00:00", cost=8.0, eff=9.0, lst=10.0, credits=credits)])
    r = out["A"]
    assert r.Cost == Decimal("10.000000000")
    assert r["Negotiated savings"] == Decimal("-1.000000000")       # eff - list
    assert r["Savings programmes"] == Decimal("-2.500000000")       # (cost - eff) + cud credits
    assert r["Other savings"] == Decimal("-0.250000000")
    assert r.Subtotal == Decimal("6.250000000")                     # cost + cud + other; unlisted counts nowhere


def test_fee_skus_move_cost(spark):
    out = breakdown(spark, [row("A", "1998-08-02 00:00:00", cost=5.0, lst=5.0, sku="fee"),
                            row("A", "1998-08-02 00:00:00", cost=7.0, lst=7.0)], fee_skus=["fee"])
    assert out["A"].Cost == Decimal("7.000000000")
    assert out["A"]["Savings programmes"] == Decimal("5.000000000")
    assert out["A"].Subtotal == Decimal("12.000000000")


def test_top10_ties_and_null_last(spark):
    rows = [row(f"S{i:02d}", "1998-08-02 00:00:00", cost=1.0) for i in range(12)]
    rows.append(((None, "Z-null"), ("s", "s"), ("p", "1"), None, None, None, "regular",
                 dt.datetime(1998, 8, 2), None))
    df = spark.createDataFrame(rows, BILL)
    got = [r["Service Description"] for r in rp.cost_breakdown(df, dt.date(1998, 8, 19)).collect()]
    assert got == [f"S{i:02d}" for i in range(10)]                   # equal subtotals: by name
    got_all = [r["Service Description"] for r in rp.cost_breakdown(df, dt.date(1998, 8, 19), limit=None).collect()]
    assert got_all[-1] == "Z-null"                                   # NULL subtotal sorts last


def test_project_scope_id_or_number(spark):
    rows = [row("A", "1998-08-02 00:00:00", project=("7", "1007")),
            row("B", "1998-08-02 00:00:00", project=("8", "1008")),
            row("C", "1998-08-02 00:00:00", project=("9", "1009"))]
    out = breakdown(spark, rows, projects=["7", "1008"], services=["A", "B", "C"])
    assert sorted(out) == ["A", "B"]


def test_partitioned_table_prunes(spark):
    df = spark.createDataFrame([row("A", "1998-08-01 00:30:00")], BILL).withColumn(
        "usage_date", F.to_date("usage_start_time"))
    assert breakdown(spark, [row("A", "1998-08-01 00:30:00")]) and rp.cost_breakdown(
        df, dt.date(1998, 8, 19)).count() == 1


def test_cur_report_rounding(spark):
    cur = spark.createDataFrame(
        [(dt.date(1998, 8, 3), "X", "Usage", 1.005), (dt.date(1998, 8, 4), "X", None, 2.0),
         (dt.date(1998, 8, 5), "X", "Tax", 3.0), (dt.date(1998, 9, 1), "X", "Usage", 4.0)],
        "usage_date date, product_name string, line_item_type string, line_item_unblended_cost double")
    out = rp.cur_cost_by_service(cur, dt.date(1998, 8, 19)).collect()
    assert [(r["Service Description"], r.Cost) for r in out] == [("X", 1.01)]
