"""The four load jobs end to end: fixture landed as raw files -> table."""

from __future__ import annotations

import datetime as dt
import io
import os
import zipfile

from conftest import SF_SMALL
from pyspark.sql import functions as F

from costframe import fixtures as fx
from costframe.functions.dates import date_in_month
from costframe.functions.numbers import round_sum2
from costframe.landing import land_cdr, land_cur, land_invoices, land_pages
from costframe.plans.loads import load_cdr, load_cur, load_invoices, load_usage
from costframe.session import as_local_path


def test_load_cur_periods_to_check(spark, workdir):
    bucket = f"{workdir}/bucket"
    land_cur(spark, fx.cur_raw(spark, SF_SMALL), bucket, "costs")
    table = f"{workdir}/cur"
    # 5 August: the current and the previous billing period are read
    info = load_cur(spark, bucket, "costs", table, as_of=dt.date(1998, 8, 5))
    got = spark.read.parquet(table)
    assert sum(v["rows"] for v in info["periods"].values()) == info["staged_rows"]
    assert info["periods"]["19980801-19980901"]["assembly_id"] == "assembly-1"
    want = fx.cur(spark, SF_SMALL).filter(date_in_month("usage_date", dt.date(1998, 8, 5))
                                          | date_in_month("usage_date", dt.date(1998, 8, 5), -1))
    assert got.count() == want.count() > 0
    assert (got.agg(round_sum2("line_item_unblended_cost")).first()[0]
            == want.agg(round_sum2("line_item_unblended_cost")).first()[0])
    # the same run again changes nothing
    load_cur(spark, bucket, "costs", table, as_of=dt.date(1998, 8, 5))
    assert spark.read.parquet(table).count() == want.count()


def test_load_cdr_lookback_window(spark, workdir):
    root = f"{workdir}/landing"
    land_cdr(spark, fx.cdr_raw(spark, SF_SMALL), root)
    table = f"{workdir}/cdr"
    as_of = dt.date(2024, 1, 19)
    info = load_cdr(spark, root, table, as_of=as_of)
    got = spark.read.parquet(table)
    assert sum(info["pairs"].values()) == info["staged_rows"] and "SMS/inbound" in info["pairs"]
    want = fx.cdr(spark, SF_SMALL).filter((F.col("usage_date") >= "2024-01-17") & (F.col("usage_date") < "2024-01-19"))
    assert got.count() == want.count() > 0
    assert sorted(r[0] for r in got.select("record_id").collect()) == sorted(
        r[0] for r in want.select("record_id").collect())


def _zip_csv(text: str) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("report.csv", text)
    return buf.getvalue()


def test_load_cdr_later_pair_wins(spark, workdir):
    root = f"{workdir}/pairs"
    head = "message_id,date_received,total_price\n"
    for direc, price in (("inbound", "1.0"), ("outbound", "2.0")):
        path = as_local_path(f"{root}/product=SMS/direction={direc}/start=2024-01-18/r.zip")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as fh:
            fh.write(_zip_csv(head + f"shared,2024-01-18 09:00:00,{price}\n"))
    table = f"{workdir}/cdr"
    load_cdr(spark, root, table, as_of=dt.date(2024, 1, 19))
    rows = spark.read.parquet(table).collect()
    assert len(rows) == 1 and rows[0].total_price == 2.0 and rows[0].direction == "outbound"


def test_load_usage_and_cost(spark, workdir):
    up, cp = f"{workdir}/usage-pages", f"{workdir}/cost-pages"
    land_pages(spark, fx.usage_buckets(spark, SF_SMALL), up)
    land_pages(spark, fx.cost_buckets(spark, SF_SMALL), cp)
    out = load_usage(spark, up, f"{workdir}/usage", cp, f"{workdir}/cost", multi_line=False)
    assert out["usage"]["staged_rows"] > 0
    n = fx.usage_buckets(spark, SF_SMALL).select(F.explode("results")).count()
    assert spark.read.parquet(f"{workdir}/usage").count() == n
    assert spark.read.parquet(f"{workdir}/cost").count() == n


def test_load_invoices(spark, workdir):
    root = f"{workdir}/inv"
    land_invoices(spark, fx.invoice_raw(spark, SF_SMALL), root)
    table = f"{workdir}/invoices"
    load_invoices(spark, root, table)
    got = spark.read.parquet(table)
    raw = fx.invoice_raw(spark, SF_SMALL)
    assert got.count() == raw.filter(F.col("`Service ID`") != "").count()
    assert dict(got.dtypes)["percent_change_vs_previous"] == "string"


def test_load_usage_lookback(spark, workdir):
    up = f"{workdir}/usage-pages"
    land_pages(spark, fx.usage_buckets(spark, SF_SMALL), up)
    out = load_usage(spark, up, f"{workdir}/usage", multi_line=False, as_of=dt.date(2024, 1, 19))
    days = sorted({r.usage_date for r in spark.read.parquet(f"{workdir}/usage").collect()})
    assert days == [dt.date(2024, 1, d) for d in (15, 16, 17, 18)] and out["usage"]["staged_rows"] > 0
