"""Job entry point: ``spark-submit -m costframe <command> ...`` or ``python -m costframe``.

Commands mirror the scheduled jobs: the four loads and the month reports.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def _csv(text: str) -> list[str]:
    return [t for t in text.split(",") if t]


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="costframe")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("load-cur", help="cost report: manifest periods -> table")
    c.add_argument("--root", required=True)
    c.add_argument("--report", required=True)
    c.add_argument("--table", required=True)
    c.add_argument("--as-of", type=_date)
    c.add_argument("--bucket-root")

    c = sub.add_parser("load-cdr", help="zipped call/message reports -> table")
    c.add_argument("--root", required=True)
    c.add_argument("--table", required=True)
    c.add_argument("--as-of", type=_date)
    c.add_argument("--products", type=_csv)
    c.add_argument("--lookback-days", type=int, default=2)

    c = sub.add_parser("load-usage", help="usage / cost JSON pages -> tables")
    c.add_argument("--usage-pages", required=True)
    c.add_argument("--usage-table", required=True)
    c.add_argument("--cost-pages")
    c.add_argument("--cost-table")
    c.add_argument("--json-lines", action="store_true", help="one page object per line")
    c.add_argument("--as-of", type=_date, help="load only the lookback window before this day")
    c.add_argument("--lookback-days", type=int, default=4)

    c = sub.add_parser("load-invoices", help="invoice CSVs -> monthly summary table")
    c.add_argument("--path", required=True)
    c.add_argument("--table", required=True)

    c = sub.add_parser("report", help="a month report, printed as JSON lines")
    c.add_argument("name", choices=["all-services", "scoped", "aws-services", "aws-monthly", "cdr-services"])
    c.add_argument("--table", required=True)
    c.add_argument("--as-of", type=_date)
    c.add_argument("--month-offset", type=int, default=None, help="0: this month; default -1 for aws-monthly, else 0")
    c.add_argument("--usage-day-col", help="the export's partition column that holds the UTC day of the usage: the report prunes by it")
    c.add_argument("--projects", type=_csv)
    c.add_argument("--services", type=_csv)
    c.add_argument("--no-limit", action="store_true")

    a = p.parse_args(argv)
    from .functions.dates import today_in
    from .plans import loads
    from .plans import reports as rp
    from .session import get_session
    from .sources.tables import table_scan

    spark = get_session(a.master)
    if a.cmd == "load-cur":
        out = loads.load_cur(spark, a.root, a.report, a.table, as_of=a.as_of, bucket_root=a.bucket_root)
    elif a.cmd == "load-cdr":
        kw = {"products": a.products} if a.products else {}
        out = loads.load_cdr(spark, a.root, a.table, as_of=a.as_of, lookback_days=a.lookback_days, **kw)
    elif a.cmd == "load-usage":
        out = loads.load_usage(spark, a.usage_pages, a.usage_table, a.cost_pages, a.cost_table,
                               multi_line=not a.json_lines, as_of=a.as_of, lookback_days=a.lookback_days)
    elif a.cmd == "load-invoices":
        out = loads.load_invoices(spark, a.path, a.table)
    else:
        as_of = a.as_of or today_in()
        t = table_scan(spark, a.table)
        limit = None if a.no_limit else rp.TOP_N
        if a.name in ("all-services", "scoped"):
            df = rp.cost_breakdown(t, as_of, month_offset=a.month_offset or 0, projects=a.projects,
                                   services=a.services, limit=limit, usage_day_col=a.usage_day_col)
        elif a.name == "aws-services":
            df = rp.cur_cost_by_service(t, as_of, month_offset=a.month_offset or 0, limit=limit)
        elif a.name == "aws-monthly":
            df = rp.cur_cost_by_service(t, as_of, month_offset=-1 if a.month_offset is None else a.month_offset, label="Service", limit=limit)
        else:
            df = rp.cdr_cost_by_category(t, as_of, month_offset=a.month_offset or 0)
        # A report is at most one row per service: bounded, safe to print.
        for row in df.toJSON().collect():
            print(row)
        return 0
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
