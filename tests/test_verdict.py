"""Late export days, tiny amounts, overlapping pulls, unknown columns and long restatements."""

from __future__ import annotations

import datetime as dt
import gzip
import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from costframe import catalog as cat
from costframe import fixtures as fx
from costframe.functions.numbers import round_sum2
from costframe.operators.cdr import normalise_cdr
from costframe.operators.invoice import normalise_invoice
from costframe.operators.tables import day_folders, merge, read_days, upsert_table, write_table
from costframe.plans import reports as rp
from costframe.plans.checks import coverage_gaps, scope_audit
from costframe.plans.loads import load_usage
from costframe.session import as_local_path, scratch_root
from costframe.sources.cur import cur_scan
from costframe.sources.invoices import invoice_scan

from conftest import SF_SMALL


def test_a_late_export_day_stays_in_the_bill(spark):
    bill = fx.bill(spark, SF_SMALL)
    late = bill.withColumn("usage_date", F.date_add(F.to_date("usage_start_time"), 400))
    assert sorted(map(str, rp.cost_breakdown(late, cat.AS_OF_SUMMER).collect())) == sorted(
        map(str, rp.cost_breakdown(bill, cat.AS_OF_SUMMER).collect()))


def test_tiny_amounts_add_up(spark):
    got = spark.range(1_000_000).select(F.lit(4e-8).alias("x"), F.lit(4e-10).alias("y")).agg(
        round_sum2("x").alias("x"), round_sum2(F.col("y") * 100).alias("y")).first()
    assert tuple(got) == (0.04, 0.04)


def page(path, day, tokens, twice=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    result = {"uncached_input_tokens": tokens, "model": "m"}
    with open(path, "w") as f:
        json.dump({"data": [{"starting_at": f"2026-05-{d:02d}T00:00:00Z", "ending_at": f"2026-05-{d + 1:02d}T00:00:00Z",
                             "results": [result] * (1 + twice)} for d in day]}, f)


def test_the_later_of_overlapping_pulls_wins(spark, workdir):
    root = as_local_path(workdir)
    page(f"{root}/pages/pull=2026-05-04/p.json", (1, 2, 3), 1)
    page(f"{root}/pages/pull=2026-05-05/p.json", (2, 3, 4), 2)
    for _ in range(2):
        load_usage(spark, f"{workdir}/pages", f"{workdir}/usage")
        got = spark.read.parquet(f"{workdir}/usage").orderBy("usage_date").collect()
        assert [(r.usage_date.day, r.uncached_input_tokens) for r in got] == [(1, 1), (2, 2), (3, 2), (4, 2)]
    page(f"{root}/pages/pull=2026-05-06/p.json", (5,), 3, twice=True)
    with pytest.raises(ValueError, match="duplicate key inside one load"):
        load_usage(spark, f"{workdir}/pages", f"{workdir}/usage")


def test_columns_that_the_table_lacks_fail_the_load(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="no column w"):
        merge(df, df.withColumn("w", F.lit(1)), ["k"])


@pytest.mark.parametrize("days", [300, 400])
def test_any_number_of_days_takes_one_path(spark, workdir, days):
    df = spark.range(3).select(F.date_add(F.lit(dt.date(2026, 1, 1)), F.col("id").cast("int")).alias("usage_date"), "id")
    write_table(df, f"{workdir}/t", new_table=True)
    asked = [dt.date(2026, 1, 2) + dt.timedelta(days=k) for k in range(days)]
    assert len(day_folders(spark, f"{workdir}/t", asked)) == 2
    assert read_days(spark, f"{workdir}/t", asked).count() == 2
    assert read_days(spark, f"{workdir}/t", asked[5:]) is None
    assert upsert_table(spark, f"{workdir}/t", df.withColumn("id", F.col("id") * 1), ["id"])["days"] == 3


def test_an_id_that_is_also_the_number_counts_once(spark):
    df = spark.createDataFrame([("7", "7"), ("7", "8")], "a string, b string")
    assert [r.rows for r in scope_audit(spark, df, "project", ["7"], ["a", "b"]).collect()] == [2]


def test_a_cluster_needs_a_shared_folder():
    sc = SimpleNamespace(master="yarn", getConf=lambda: SimpleNamespace(get=lambda *_: None), getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=sc))


def test_limit_zero_is_no_row(spark):
    assert rp.cost_breakdown(fx.bill(spark, SF_SMALL), cat.AS_OF_SUMMER, limit=0).count() == 0


def test_invoice_columns_go_by_each_files_header(spark, workdir):
    root = as_local_path(f"{workdir}/inv")
    os.makedirs(root)
    files = {"a [1] 2026-01-31.csv": "Service ID,Subtotal ($),Service description\r\ns1,1.5,One\r\n",
             "b 2026-02-28.csv": "Service description,Service ID,List cost ($),Subtotal ($)\nOne,s1,9,2.5\n",
             "c 2026-03-31.csv": ""}
    for name, text in files.items():
        with open(f"{root}/{name}", "w", newline="") as f:
            f.write(text)
    got = normalise_invoice(invoice_scan(spark, f"{workdir}/inv")).orderBy("invoice_month").collect()
    assert [(r.service_id, r.service_description, r.list_cost, r.subtotal) for r in got] == [
        ("s1", "One", None, 1.5), ("s1", "One", 9.0, 2.5)]


def test_a_folder_without_invoices_is_an_empty_load(spark, workdir):
    os.makedirs(as_local_path(f"{workdir}/none"))
    assert normalise_invoice(invoice_scan(spark, f"{workdir}/none")).count() == 0


def test_rows_without_an_id_are_told_apart_by_any_column(spark):
    rows = spark.createDataFrame([("SMS", None, "2026-05-01T00:00:00Z", text) for text in ('{"x": "1"}', '{"x": "2"}')],
                                 "product string, direction_requested string, request_start string, raw_json string")
    assert normalise_cdr(rows).select("record_id").distinct().count() == 2


def test_report_parts_go_by_their_own_header_if_the_manifest_has_none(spark, workdir):
    period, keys = "20240101-20240201", []
    texts = ("id,name,cost\r\na,One,1\r\n", "name,id\nTwo,b\n", "id,name,cost\nc,Three,3\n")
    for k, text in enumerate(texts):
        keys.append(f"r/{period}/asm/r-{k}.csv.gz")
        path = as_local_path(f"{workdir}/{keys[-1]}")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with gzip.open(path, "wb") as f:
            f.write(text.encode())
    with open(as_local_path(f"{workdir}/r/{period}/r-Manifest.json"), "w") as f:
        json.dump({"assemblyId": "asm", "reportKeys": keys}, f)
    got = cur_scan(spark, workdir, "r", [period]).orderBy("id").collect()
    assert [(r.id, r.name, r.cost) for r in got] == [("a", "One", "1"), ("b", "Two", None), ("c", "Three", "3")]


def test_gaps_are_the_days_between_days(spark):
    days = [dt.date(2026, 1, d) for d in (1, 1, 2, 5, 6, 8)] + [None]
    df = spark.createDataFrame([(d,) for d in days], "usage_date date")
    assert [r.day.day for r in coverage_gaps(df, "t").orderBy("day").collect()] == [3, 4, 7]
    assert coverage_gaps(df.where("false"), "t").count() == 0
