"""File scans over small hand-written files (FIXTURES.md part C)."""

from __future__ import annotations

import datetime as dt
import gzip
import io
import json
import os
import zipfile

import pytest

from costframe.operators.cdr import normalise_cdr, request_pairs
from costframe.operators.cur import normalise_cur
from costframe.operators.invoice import normalise_invoice, reconcile_invoice
from costframe.operators.usage import flatten_cost, flatten_usage
from costframe.session import as_local_path
from costframe.sources import files
from costframe.sources.buckets import COST_RESULT, USAGE_RESULT, bucket_scan
from costframe.sources.cdr import zip_csv_scan
from costframe.sources.cur import cur_scan
from costframe.sources.invoices import invoice_scan


def _write(path: str, data: bytes) -> None:
    path = as_local_path(path)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data)


def _gz_csv(text: str) -> bytes:
    return gzip.compress(text.encode("utf-8"))


CUR_HEADER = ("identity/LineItemId,lineItem/UsageStartDate,lineItem/UnblendedCost,lineItem/LineItemType,"
              "product/ProductName,resourceTags/user:environment,lineItem/LineItemDescription\n")


def test_cur_manifest_scan(spark, workdir):
    root, report = f"{workdir}/bucket", "costs"
    period = "20240101-20240201"
    p1 = CUR_HEADER + 'id-1,2024-01-03T00:00:00Z,1.5,Usage,Svc A,prod,"a, quoted ""comma"""\n'
    p2 = CUR_HEADER + 'id-2,2024-01-04T05:00:00Z, abc ,Tax,Svc B,,"two\nlines"\n'
    _write(f"{root}/{report}/{period}/asm-2/{report}-1.csv.gz", _gz_csv(p1))
    _write(f"{root}/{report}/{period}/asm-2/{report}-2.csv.gz", _gz_csv(p2))
    # an older assembly: never named by the manifest, so never read
    _write(f"{root}/{report}/{period}/asm-1/{report}-1.csv.gz", _gz_csv(CUR_HEADER + "old,2024-01-01,9,Usage,X,,\n"))
    manifest = {"assemblyId": "asm-2", "reportKeys": [f"{report}/{period}/asm-2/{report}-1.csv.gz",
                                                      f"{report}/{period}/asm-2/{report}-2.csv.gz"]}
    _write(f"{root}/{report}/{period}/{report}-Manifest.json", json.dumps(manifest).encode())
    # a period whose only part has a header and no rows
    empty_period = "20240201-20240301"
    _write(f"{root}/{report}/{empty_period}/asm-9/{report}-1.csv.gz", _gz_csv(CUR_HEADER))
    _write(f"{root}/{report}/{empty_period}/{report}-Manifest.json",
           json.dumps({"assemblyId": "asm-9", "reportKeys": [f"{report}/{empty_period}/asm-9/{report}-1.csv.gz"]}).encode())

    raw = cur_scan(spark, root, report, ["20231201-20240101", period, empty_period])  # first has no manifest
    out = {r.line_item_id: r for r in normalise_cur(raw).collect()}
    assert set(out) == {"id-1", "id-2"}
    assert out["id-1"].usage_date == dt.date(2024, 1, 3)
    assert out["id-1"].line_item_unblended_cost == 1.5
    assert out["id-1"].line_item_description == 'a, quoted "comma"'
    assert out["id-2"].line_item_unblended_cost is None          # ' abc ' -> NULL
    assert out["id-2"].line_item_description == "two\nlines"
    assert out["id-2"].resource_tags_environment is None         # '' -> NULL
    assert out["id-1"].pricing_unit is None                      # column absent from the file
    assert cur_scan(spark, root, report, ["20231201-20240101"]).count() == 0


def _zip(members: dict[str, str]) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, text in members.items():
            zf.writestr(name, text)
    return buf.getvalue()


def test_zip_scan_and_normalise(spark, workdir):
    root = f"{workdir}/cdr"
    sms = ("message_id,direction,date_received,total_price,currency,network,country,status\n"
           "m1,outbound,2024-01-18 10:00:00,0.05,,net,GB,delivered\n"
           "m2,,2024-01-18 11:00:00,n/a,,net,GB,delivered\n")
    tts = "id,creation_date,total_price,currency\nt1,,0.5,EUR\n"
    _write(f"{root}/product=SMS/direction=inbound/start=2024-01-17/r.zip",
           _zip({"notes.txt": "not a csv", "report.csv": sms}))
    _write(f"{root}/product=VOICE-TTS/direction=__HIVE_DEFAULT_PARTITION__/start=2024-01-17/r.zip",
           _zip({"report.csv": tts}))
    out = {r.record_id: r for r in normalise_cdr(zip_csv_scan(spark, root)).collect()}
    assert out["m1"].direction == "outbound" and out["m1"].category == "SMS"
    assert out["m2"].direction == "inbound"                      # blank row value -> requested
    assert out["m2"].total_price is None
    assert out["m1"].currency == ""                              # blank stays blank
    assert out["t1"].usage_date == dt.date(2024, 1, 17)          # falls back to the request start
    assert out["t1"].category == "Other" and out["t1"].direction is None
    assert json.loads(out["m1"].raw)["message_id"] == "m1"
    only_sms = zip_csv_scan(spark, root, products=["SMS"])
    assert only_sms.count() == 2
    streamed = {r.record_id: r for r in normalise_cdr(zip_csv_scan(spark, root, read_content=False)).collect()}
    assert {k: tuple(v) for k, v in streamed.items()} == {k: tuple(v) for k, v in out.items()}


def test_request_pairs():
    assert request_pairs(["SMS", "VOICE-TTS"]) == [("SMS", "inbound"), ("SMS", "outbound"), ("VOICE-TTS", None)]


def test_cdr_row_hash_fallback(spark):
    df = spark.createDataFrame([("SMS", "inbound", "2024-01-01T00:00:00Z", "x", "1.0")],
                               "product string, direction_requested string, request_start string, "
                               "network string, total_price string")
    r = normalise_cdr(df).first()
    assert len(r.record_id) == 64 and r.usage_date == dt.date(2024, 1, 1)


USAGE_PAGE_1 = {
    "data": [
        {"starting_at": "2025-08-01T00:00:00Z", "ending_at": "2025-08-02T00:00:00Z", "results": [
            {"account_id": "a", "workspace_id": None, "model": "m1", "uncached_input_tokens": 10,
             "cache_read_input_tokens": 2, "output_tokens": 5,
             "cache_creation": {"ephemeral_5m_input_tokens": 1, "ephemeral_1h_input_tokens": 3},
             "server_tool_use": {"web_search_requests": 4}},
            {"account_id": "a", "workspace_id": "w", "model": "m2", "uncached_input_tokens": 1,
             "output_tokens": 1, "cache_creation": None}]},
        {"starting_at": "2025-08-02T00:00:00Z", "ending_at": "2025-08-03T00:00:00Z", "results": []},
    ],
    "has_more": True, "next_page": "p2"}
USAGE_PAGE_2 = {"data": [{"starting_at": "2025-08-03T00:00:00Z", "ending_at": "2025-08-04T00:00:00Z",
                          "results": [{"model": "m1", "uncached_input_tokens": 7}]}],
                "has_more": False, "next_page": None}


def test_bucket_pages(spark, workdir):
    root = f"{workdir}/pages"
    _write(f"{root}/page-1.json", json.dumps(USAGE_PAGE_1, indent=2).encode())
    _write(f"{root}/page-2.json", json.dumps(USAGE_PAGE_2, indent=2).encode())
    rows = flatten_usage(bucket_scan(spark, root, USAGE_RESULT)).collect()
    assert len(rows) == 3                                        # the empty bucket adds none
    by_model = {(r.usage_date, r.model): r for r in rows}
    r1 = by_model[(dt.date(2025, 8, 1), "m1")]
    assert r1.cache_creation_ephemeral_1h_input_tokens == 3 and r1.web_search_requests == 4
    r2 = by_model[(dt.date(2025, 8, 1), "m2")]
    assert r2.cache_creation_ephemeral_5m_input_tokens is None   # null sub-record
    r3 = by_model[(dt.date(2025, 8, 3), "m1")]
    assert r3.cache_creation_ephemeral_5m_input_tokens is None   # absent sub-record
    import hashlib
    key = "2025-08-01|a|None|None|None|m1|None|None|None"
    assert r1.record_id == hashlib.sha256(key.encode()).hexdigest()


def test_cost_amount_must_parse(spark, workdir):
    root = f"{workdir}/cost"
    page = {"data": [{"starting_at": "2025-08-01T00:00:00Z", "ending_at": "2025-08-02T00:00:00Z",
                      "results": [{"amount": "123.78912", "currency": "USD", "description": "d"},
                                  {"amount": "n/a", "currency": "USD", "description": "e"}]}]}
    _write(f"{root}/p.json", json.dumps(page).encode())
    with pytest.raises(Exception, match="not a number"):
        flatten_cost(bucket_scan(spark, root, COST_RESULT)).collect()


INVOICE_HEADER = ("Service description,Service ID,List cost ($),Negotiated savings ($),Savings programmes ($),"
                  "Other savings ($),Unrounded subtotal ($),Subtotal ($),"
                  "Percent change in subtotal compared to previous period\n")


def test_invoice_scan(spark, workdir):
    root = f"{workdir}/inv"
    _write(f"{root}/Invoice 2026-05-01.csv", (INVOICE_HEADER +
           "Compute,AAAA-1, 100.50 ,-10,-5,0,85.5,85.50,New\n"
           "Storage,BBBB-2,20,-2,-1,0,17,17.00,12.5\n"
           "Subtotal,,120.50,-12,-6,0,102.5,102.50,\n"
           "Tax,,,,,,,0,\n").encode())
    _write(f"{root}/Invoice 2026-06-01.csv", (INVOICE_HEADER +
           "Compute,AAAA-1,1,0,0,0,1,1.00,3.5\n"
           "Subtotal,,1,0,0,0,1,1.00,\n").encode())
    raw = invoice_scan(spark, root)
    out = normalise_invoice(raw).orderBy("invoice_month", "service_id").collect()
    assert [(r.invoice_month, r.service_id) for r in out] == [
        (dt.date(2026, 5, 1), "AAAA-1"), (dt.date(2026, 5, 1), "BBBB-2"), (dt.date(2026, 6, 1), "AAAA-1")]
    assert out[0].list_cost == 100.5 and out[0].percent_change_vs_previous == "New"
    assert out[2].percent_change_vs_previous == "3.5"            # all-numeric month stays text
    assert dict(normalise_invoice(raw).dtypes)["percent_change_vs_previous"] == "string"
    rec = {r.invoice_month: r for r in reconcile_invoice(raw).collect()}
    assert rec[dt.date(2026, 5, 1)].matches and rec[dt.date(2026, 5, 1)].services == 2


def test_invoice_without_date_fails(spark, workdir):
    root = f"{workdir}/inv-bad"
    _write(f"{root}/invoice.csv", (INVOICE_HEADER + "Compute,A,1,0,0,0,1,1,New\n").encode())
    with pytest.raises(Exception, match="no YYYY-MM-DD date"):
        normalise_invoice(invoice_scan(spark, root)).collect()


def test_headers_come_from_one_job(spark, workdir):
    """Gzip and plain files, a byte order mark, blank names, a quoted line break; no record, no header."""
    import gzip

    folder = as_local_path(f"{workdir}/headers")
    os.makedirs(folder)
    texts = {"a.csv": "x,y\n1,2\n", "b.csv": "\ufeffx,y\n3,4\n", "c.csv": '"x\nz",\n5,6\n', "d.csv": "", "e.csv.gz": "x,y\n" + "7,8\n" * 9}
    for name, text in texts.items():
        with (gzip.open if name.endswith(".gz") else open)(f"{folder}/{name}", "wb") as fh:
            fh.write(text.encode())
    got = files.csv_headers(spark, [f"{folder}/{n}" for n in texts])
    assert {k: [p.rsplit("/", 1)[1] for p in v] for k, v in got.items()} == {("x", "y"): ["a.csv", "b.csv", "e.csv.gz"], ("x\nz", "_c1"): ["c.csv"]}
    assert files.csv_headers(spark, []) == {}
