"""Zipped reports as a Python data source: pruned listing, streaming, odd archives, empty loads."""

from __future__ import annotations

import datetime as dt
import os
import pickle
import zipfile

import pytest
from pyspark.sql import datasource as ds

from costframe.operators.cdr import normalise_cdr
from costframe.plans import loads
from costframe.session import as_local_path
from costframe.sources import cdr, zip_reports as zr
from costframe.sources.buckets import USAGE_RESULT, bucket_scan
from costframe.sources.invoices import invoice_scan


def land(root, product, direction, start, name, members):
    path = as_local_path(f"{root}/product={product}/direction={direction}/start={start}/{name}")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w") as zf:
        for member, text in members:
            zf.writestr(member, text)


@pytest.fixture()
def landing(spark, workdir):
    root = f"{workdir}/landing"
    for product in ("SMS", "VOICE-CALL"):
        for day in range(1, 6):
            land(root, product, "outbound", f"2024-01-0{day}", "r.zip", [("x.txt", "no"), ("a.csv", f"id,status,extra\n{product}{day},,1\n{product}{day}b,ok,2\n")])
    land(root, "VOICE-TTS", zr.NULL_FOLDER, "2024-01-02", "r.zip", [("a.csv", 'id,from\nt1,"a\nb"\nt2\n')])
    land(root, "SMS", "outbound", "2024-01-01", "empty.zip", [("readme.txt", "nothing")])
    land(root, "SMS", "outbound", "2024-01-01", "header.zip", [("a.csv", "id,status\n")])
    return root


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_the_binary_file_scan(spark, landing):
    for kw in ({}, {"products": ["SMS", "VOICE-TTS"]}, {"since": dt.date(2024, 1, 2), "until": dt.date(2024, 1, 4)}, {"products": []}):
        want, got = cdr.zip_csv_scan(spark, landing, **kw), zr.zip_report_scan(spark, landing, **kw)
        assert got.columns == want.columns and rows(got) == rows(want), kw
    assert len(rows(normalise_cdr(zr.zip_report_scan(spark, landing)))) == 22


def test_filters_prune_the_listing(landing):
    reader = zr.ZipReader(landing)
    pushed = [ds.In(("product",), ("SMS",)), ds.GreaterThanOrEqual(("request_day",), dt.date(2024, 1, 2)), ds.LessThan(("request_day",), dt.date(2024, 1, 4)),
              ds.IsNotNull(("request_day",)), ds.EqualTo(("raw_status",), "ok"), ds.StringStartsWith(("product",), "S")]
    assert [type(f).__name__ for f in reader.pushFilters(pushed)] == ["EqualTo", "StringStartsWith"]
    found = pickle.loads(pickle.dumps(reader)).partitions()
    assert [(a.values[0], a.values[2].day) for a in found] == [("SMS", 2), ("SMS", 3)]
    reader.partitions()
    assert not [f for f in reader.listed if "VOICE" in f or "2024-01-01" in f or "2024-01-05" in f]


def test_the_plan_pushes_the_window(spark, landing):
    df = zr.zip_report_scan(spark, landing, ["SMS"], dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in p and df.rdd.getNumPartitions() == 1, p
    assert zr.zip_report_scan(spark, landing).rdd.getNumPartitions() == 13  # an archive a partition


def test_null_direction_matches_only_null(landing):
    reader = zr.ZipReader(landing)
    list(reader.pushFilters([ds.IsNull(("direction_requested",))]))
    assert [a.values[0] for a in reader.partitions()] == ["VOICE-TTS"]
    reader = zr.ZipReader(landing)
    list(reader.pushFilters([ds.EqualTo(("direction_requested",), "outbound")]))
    assert {a.values[0] for a in reader.partitions()} == {"SMS", "VOICE-CALL"}


def test_a_large_member_comes_in_batches(workdir):
    text = "id,status\n" + "".join(f"r{k},ok\n" for k in range(2 * cdr.BATCH_ROWS + 5))
    land(f"{workdir}/big", "SMS", "outbound", "2024-01-01", "big.zip", [("a.csv", text)])
    reader = zr.ZipReader(f"{workdir}/big")
    sizes = [b.num_rows for a in reader.partitions() for b in reader.read(a)]
    assert sizes == [cdr.BATCH_ROWS, cdr.BATCH_ROWS, 5]


@pytest.mark.parametrize("made", [False, True])
def test_nothing_landed_is_an_empty_load(spark, workdir, made):
    root = f"{workdir}/none-{made}"
    if made:
        os.makedirs(as_local_path(root))
    assert zr.zip_report_scan(spark, root, ["SMS"], dt.date(2024, 1, 1)).count() == 0
    out = loads.load_cdr(spark, root, f"{workdir}/t", as_of=dt.date(2024, 1, 5))
    assert (out["staged_rows"], out["days"]) == (0, 0) and not os.path.exists(as_local_path(f"{workdir}/t"))
    assert bucket_scan(spark, root, USAGE_RESULT, pull="load_ordinal").count() == 0
    assert loads.load_usage(spark, root, f"{workdir}/u")["usage"] == {"staged_rows": 0, "days": 0}
    assert invoice_scan(spark, f"{root}/*.csv").count() == 0


def test_a_load_takes_only_its_window(spark, landing, workdir):
    out = loads.load_cdr(spark, landing, f"{workdir}/t", as_of=dt.date(2024, 1, 4), lookback_days=2)
    assert out["staged_rows"] == 10 and out["pairs"]["SMS/outbound"] == 4
