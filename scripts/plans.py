"""Write PLANS.md: the final (post-AQE) physical plans of the key queries.

Usage: python scripts/plans.py [sf_dir]   (default /root/testdata/sf0.01)

Builds day-partitioned tables from the fixtures in the scratch folder, runs
each query once and records the executed (final, post-AQE) plan, so the plan shape
is reviewable: partition/pushed filters, partial aggregates, exchanges, join
strategies chosen at runtime.
"""

from __future__ import annotations

import os
import re
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F

    from costframe import catalog as cat
    from costframe import fixtures as fx
    from costframe.operators.cdr import CDR_KEYS, normalise_cdr
    from costframe.operators.cur import CUR_KEYS, normalise_cur
    from costframe.operators import bucketed as bk
    from costframe.operators.tables import day_layout, merged_days, read_days, upsert_table, write_table
    from costframe.plans import daysums as ds
    from costframe.plans import checks as ck
    from costframe.plans import reports as rp
    from costframe.session import get_session, scratch_path

    spark = get_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    bill_p, cur_p, cdr_p = (scratch_path(spark, n) for n in ("plan-bill", "plan-cur", "plan-cdr"))
    write_table(fx.bill(spark, sf_dir).withColumn("usage_date", F.to_date("usage_start_time")), bill_p,
                new_table=True)
    upsert_table(spark, cur_p, normalise_cur(fx.cur_raw(spark, sf_dir)), list(CUR_KEYS))
    upsert_table(spark, cdr_p, normalise_cdr(fx.cdr_raw(spark, sf_dir)), list(CDR_KEYS))
    bill, cur, cdr = (spark.read.parquet(p) for p in (bill_p, cur_p, cdr_p))
    A = cat.AS_OF_SUMMER
    restate = cdr.filter(F.col("usage_date") >= "2024-01-28").withColumn("total_price", F.col("total_price") + 1)
    days = [r[0] for r in restate.select("usage_date").distinct().collect()]

    restate_p, sums_p, buckets_p, name = (*(scratch_path(spark, n) for n in ("plan-restate", "plan-sums", "plan-buckets")), "plan_cdr_buckets")
    restate.write.parquet(restate_p)
    staged = spark.read.parquet(restate_p)
    layout = day_layout({d: 1 << 20 for d in days}, 32)
    layout = spark.createDataFrame(layout, "usage_date date, _pack int, _parts int")
    ds.refresh_day_sums(spark, bill, sums_p)
    bk.create_bucketed(cdr, name, list(CDR_KEYS), 4, buckets_p)
    with bk._settings(spark):
        co_located = bk.merged_buckets(spark, name, staged, list(CDR_KEYS), days)
        co_located.collect()

    cases = {
        "Q1 all services over the day-partitioned export": rp.cost_breakdown(bill, A, usage_day_col="usage_date"),
        "Q2 scoped top 10 (project id OR number, service ids)":
            rp.cost_breakdown(bill, A, usage_day_col="usage_date", projects=cat.PLATFORM_PROJECTS, services=cat.PLATFORM_SERVICES),
        "Q4 cost-and-usage by service (DATE partitions)": rp.cur_cost_by_service(cur, A),
        "Q1 over the fixture view (lineitem x part)": rp.cost_breakdown(fx.bill(spark, sf_dir), A),
        "Q1 from day sums (the export is not opened)": ds.cost_from_day_sums(spark.read.parquet(sums_p), A),
        "Upsert of a restatement: staged rows and the target's days meet in one exchange, the layout they are written in":
            merged_days(staged, read_days(spark, cdr_p, days), list(CDR_KEYS), layout, len(days), "usage_date", None, False),
        "Co-located merge into a bucketed table: only the load is shuffled": co_located,
        "D2 coverage from the listing": ck.coverage(ck.day_listing(spark, cur_p), "cur"),
        "D2 day bitmaps by service": ck.day_bitmaps(cur, "product_name"),
        "D2 coverage gaps": ck.coverage_gaps(cur, "cur"),
        "D4 scope audit": ck.scope_audit(spark, bill, "project", cat.AUDIT_PROJECTS,
                                         ["project.id", "project.number"]),
        "J2 per-row credits, lateral form": rp.credit_columns_lateral(spark, bill),
        "D5 month-source union": cat.queries()["month_source_union"](spark, sf_dir),
    }
    out = ["# PLANS", "",
           f"Final (post-AQE) physical plans at `{sf_dir}`, written by `scripts/plans.py`.",
           "Tables are the fixtures written day-partitioned as the loads write them.", ""]
    for title, df in cases.items():
        df.collect()  # same QueryExecution, so AQE's final plan is what gets printed
        tree = df._jdf.queryExecution().executedPlan().toString()
        tree = re.sub(r"#\d+L?", "", tree)
        tree = re.sub(r"file:[^\]\s,]*", "<path>", tree)
        full = tree.splitlines()
        body = [ln[:200] for ln in full if "FileScan" not in ln and "Scan " not in ln]
        out += [f"## {title}", "", "```", *body[:45], "```", ""]
        for s_ in [ln for ln in full if "FileScan" in ln][:3]:
            parts = []
            for k in ("PartitionFilters", "PushedFilters"):
                m = re.search(k + r": \[([^\]]*)\]", s_)
                if m:
                    parts.append(f"{k}: [{m.group(1)[:200]}]")
            rs = re.search(r"ReadSchema: (\S+)", s_)
            if rs:
                parts.append(f"ReadSchema: {rs.group(1)[:200]}")
            out.append("* scan: " + "; ".join(parts))
        out.append("")
    with open(os.path.join(HERE, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
