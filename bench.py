"""Benchmark: the loads and the reports, as the reference runs them.

Phase 1 (loads): raw landed shapes -> normalise -> keyed upsert into
day-partitioned Parquet tables (cost report, call records, usage, cost
buckets) and a restatement re-load of the last days (touches only those day
folders).  Writing the billing export day-partitioned is setup (the export is
produced upstream, not by these jobs): it is timed and reported under
"setup", outside the total.
Phase 2 (reports): the month reports and checks over those tables.
Phase 3 (views): registered queries straight over the driver's tables.

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf"}.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_EVENT_LOG=1 to write Spark's event log (stage / task times) under the
scratch folder (the UI stays off).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from pyspark.sql import functions as F

    from costframe import catalog as cat
    from costframe import fixtures as fx
    from costframe.operators.cdr import CDR_KEYS, normalise_cdr
    from costframe.operators.cur import CUR_KEYS, normalise_cur
    from costframe.operators.tables import upsert_table, write_table
    from costframe.operators.usage import USAGE_KEYS, flatten_cost, flatten_usage
    from costframe.plans import checks as ck
    from costframe.plans import reports as rp
    from costframe.session import get_session, scratch_path

    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        import tempfile
        root = os.environ.get("BENCH_EVENT_LOG_DIR") or tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{root}"}
        print(f"event log: {root}", file=sys.stderr)
    spark = get_session(f"local[{cpus}]", app="costframe-bench", shuffle_partitions=2 * cpus, extra_conf=extra)
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    setup: dict[str, float] = {}

    def timed(name, fn, into=None):
        t0 = time.perf_counter()
        out = fn()
        (times if into is None else into)[name] = round(time.perf_counter() - t0, 3)
        return out

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    # Start-up (JVM, first job) is a cost of the session, not of a query.
    timed("session_warmup", lambda: spark.range(1000).selectExpr("sum(id)").collect(), setup)

    # ---------------------------------------------------------------- loads
    tables = {k: scratch_path(spark, f"bench-{k}") for k in ("cur", "cdr", "usage", "cost", "bill")}
    timed("load_cur", lambda: upsert_table(spark, tables["cur"], normalise_cur(fx.cur_raw(spark, sf_dir)),
                                           list(CUR_KEYS)))
    timed("load_cdr", lambda: upsert_table(spark, tables["cdr"], normalise_cdr(fx.cdr_raw(spark, sf_dir)),
                                           list(CDR_KEYS)))
    timed("load_usage", lambda: upsert_table(spark, tables["usage"],
                                             flatten_usage(fx.usage_buckets(spark, sf_dir)), list(USAGE_KEYS)))
    timed("load_cost", lambda: upsert_table(spark, tables["cost"],
                                            flatten_cost(fx.cost_buckets(spark, sf_dir)), list(USAGE_KEYS)))

    def restate():
        # Restatement: the report's last 7 days arrive again with new values.
        raw = normalise_cur(fx.cur_raw(spark, sf_dir))
        last = dt.date(2001, 11, 4)
        src = (raw.filter(F.col("usage_date") > F.lit(last - dt.timedelta(days=7)))
                  .withColumn("line_item_unblended_cost", F.col("line_item_unblended_cost") * 1.01))
        upsert_table(spark, tables["cur"], src, list(CUR_KEYS))
    timed("restate_cur_7d", restate)

    def load_bill():
        b = fx.bill(spark, sf_dir).withColumn("usage_date", F.to_date("usage_start_time"))
        write_table(b, tables["bill"], new_table=True)
    timed("bill_export_table", load_bill, setup)

    # Daily jobs as they run: land the raw files (setup), then the load job
    # reads them through the manifest / zip sources.
    from costframe.landing import land_cdr, land_cur
    from costframe.plans.loads import load_cdr, load_cur

    cur_bucket = scratch_path(spark, "bench-cur-landing")
    cdr_landing = scratch_path(spark, "bench-cdr-landing")
    timed("land_cur_files", lambda: land_cur(spark, fx.cur_raw(spark, sf_dir), cur_bucket, "costs"), setup)
    timed("land_cdr_zips", lambda: land_cdr(spark, fx.cdr_raw(spark, sf_dir), cdr_landing), setup)
    timed("daily_load_cur_2_periods", lambda: load_cur(spark, cur_bucket, "costs", tables["cur"],
                                                       as_of=dt.date(2001, 11, 5)))
    timed("daily_load_cdr_lookback", lambda: load_cdr(spark, cdr_landing, tables["cdr"],
                                                      as_of=dt.date(2024, 1, 19)))

    bill = spark.read.parquet(tables["bill"])
    cur = spark.read.parquet(tables["cur"])
    cdr = spark.read.parquet(tables["cdr"])
    usage = spark.read.parquet(tables["usage"])

    # ---------------------------------------------------------------- reports
    A, W, C = cat.AS_OF_SUMMER, cat.AS_OF_WINTER, cat.CDR_AS_OF
    reports = {
        "q1_all_services": lambda: rp.cost_breakdown(bill, A, usage_day_col="usage_date"),
        "q2_platform_top10": lambda: rp.cost_breakdown(bill, A, usage_day_col="usage_date", projects=cat.PLATFORM_PROJECTS,
                                                       services=cat.PLATFORM_SERVICES),
        "q3_api_all": lambda: rp.cost_breakdown(bill, A, usage_day_col="usage_date", projects=cat.API_PROJECTS,
                                                services=cat.API_SERVICES, limit=None),
        "q7_arrears": lambda: rp.cost_breakdown(bill, A, usage_day_col="usage_date", month_offset=-1, projects=cat.PLATFORM_PROJECTS,
                                                services=cat.PLATFORM_SERVICES),
        "d12_cud_fee": lambda: rp.cost_breakdown(bill, A, usage_day_col="usage_date", fee_skus=cat.FEE_SKUS),
        "q4_cur_services": lambda: rp.cur_cost_by_service(cur, A),
        "q5_cur_monthly": lambda: rp.cur_cost_by_service(cur, W, month_offset=-1, label="Service"),
        "d6_cur_effective": lambda: rp.cur_cost_by_service(cur, A, effective=True),
        "d8_cur_environment": lambda: rp.cur_cost_by_environment(cur, A),
        "q6_cdr_services": lambda: rp.cdr_cost_by_category(cdr, C),
        "d11_side_by_side": lambda: rp.sources_side_by_side(bill, cur, cdr, usage_day_col="usage_date", bill_as_of=A, cur_as_of=A,
                                                            cdr_as_of=C),
        "d7_usage_input": lambda: rp.usage_input_by_day(usage),
        "d1_freshness": lambda: ck.freshness(cur, "cur", cat.FRESH_CUR_AS_OF),
        "d2_coverage_gaps": lambda: ck.coverage_gaps(cur, "cur"),
        "d9_duplicate_keys": lambda: ck.duplicate_keys(fx.table(spark, sf_dir, "lineitem"),
                                                       ["l_orderkey", "l_linenumber"]),
        "d4_scope_audit": lambda: ck.scope_audit(spark, bill, "project", cat.AUDIT_PROJECTS,
                                                 ["project.id", "project.number"]),
    }
    for name, build in reports.items():
        timed(name, lambda b=build: run(b()))

    # ------------------------------------------------------ registered views
    qs = cat.queries()
    for name in ["bill_all_services", "credit_sums", "upsert_last_wins", "invoice_reconcile",
                 "month_source_union", "usage_rollup", "stream_usage_upsert"]:
        timed(f"view_{name}", lambda n=name: run(qs[n](spark, sf_dir)))

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds_loads_reports_views", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else sf_dir, "setup": setup}))
    spark.stop()


if __name__ == "__main__":
    main()
