"""The four load jobs: landed files -> typed day-partitioned tables.

Each job is scan -> normalise -> conform -> upsert, one Spark plan per load
plus the upsert's staging write.  Where the reference merges several pulls
one after another (billing periods, product x direction pairs, invoice
files), the pulls carry a load ordinal and the upsert keeps the latest per
key in a single pass.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import lookback, period_labels_to_check, today_in
from ..operators.cdr import CDR_KEYS, normalise_cdr, request_pairs
from ..operators.cur import CUR_KEYS, normalise_cur
from ..operators.invoice import INVOICE_KEYS, normalise_invoice
from ..operators.tables import ORDINAL, conform, upsert_table
from ..operators.usage import USAGE_KEYS, flatten_cost, flatten_usage
from ..schemas import CDR_SCHEMA, COST_SCHEMA, CUR_SCHEMA, INVOICE_SCHEMA, USAGE_SCHEMA, required
from ..sources.buckets import COST_RESULT, USAGE_RESULT, bucket_scan
from ..sources.cur import cur_scan
from ..sources.invoices import invoice_scan
from ..sources.zip_reports import zip_report_scan

# Default products pulled and days re-read per run.
CDR_PRODUCTS = ["SMS", "VOICE-CALL", "VOICE-TTS", "WEBSOCKET-CALL"]
CDR_LOOKBACK_DAYS = 2
USAGE_LOOKBACK_DAYS = 4


def _typed(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """conform() to the table schema, carrying bookkeeping columns along."""
    return conform(df, schema, required(schema), keep)


def _ordinal(cases: list[tuple[Column, int]]) -> Column:
    expr = None
    for cond, i in cases:
        expr = F.when(cond, i) if expr is None else expr.when(cond, i)
    return expr if expr is not None else F.lit(0)


def load_cur(spark: SparkSession, root: str, report: str, table_path: str,
             as_of: dt.date | None = None, periods: Sequence[str] | None = None,
             bucket_root: str | None = None) -> dict:
    """Cost report: the periods to check (current, plus the previous one in
    the first week), each through its manifest; a later period wins on a
    shared key."""
    labels = list(periods) if periods is not None else period_labels_to_check(as_of or today_in("UTC"))
    raw = cur_scan(spark, root, report, labels, bucket_root)
    if "billing_period" not in raw.columns or not raw.columns[2:]:
        return {"staged_rows": 0, "days": 0}
    raw = raw.withColumn(ORDINAL, _ordinal([(F.col("billing_period") == p, i) for i, p in enumerate(labels)]))
    # Rows and assembly of each period, seen on the pass that loads them (K8); a period without rows has none.
    obs = Observation("cur_periods")
    of = {p: F.col("billing_period") == p for p in labels}
    raw = raw.observe(obs, *[F.count_if(of[p]).alias(p) for p in labels],
                      *[F.max(F.when(of[p], F.col("assembly_id"))).alias(f"{p} assembly") for p in labels])
    rows = normalise_cur(raw, extra=[ORDINAL])
    out = upsert_table(spark, table_path, _typed(rows, CUR_SCHEMA, [ORDINAL]), list(CUR_KEYS), ordinal=ORDINAL)
    seen = obs.get
    out["periods"] = {p: {"assembly_id": seen.get(f"{p} assembly"), "rows": seen.get(p, 0)} for p in labels}
    return out


def load_cdr(spark: SparkSession, root: str, table_path: str, as_of: dt.date | None = None,
             products: Sequence[str] = tuple(CDR_PRODUCTS),
             lookback_days: int = CDR_LOOKBACK_DAYS) -> dict:
    """Call records: the landed pulls of the lookback window.  When an id appears
    in two pulls the later request window wins, then the later (product, direction) pair."""
    as_of = as_of or today_in("UTC")
    # The landed request day is a folder name: only the window's folders are
    # listed and unzipped; a folder that nothing landed in is an empty load.
    raw = zip_report_scan(spark, root, list(products),
                          since=as_of - dt.timedelta(days=lookback_days), until=as_of)
    cases = []
    for i, (prod, direc) in enumerate(request_pairs(list(products))):
        same_dir = (F.col("direction_requested").isNull() if direc is None
                    else F.col("direction_requested") == direc)
        cases.append(((F.col("product") == prod) & same_dir, i))
    # A later request window wins over an earlier one, then a later pair of it;
    # pairs that weren't asked for come last.
    pair = F.coalesce(_ordinal(cases), F.lit(len(cases)))
    raw = raw.withColumn(ORDINAL, F.struct(F.coalesce("request_start", F.lit("")).alias("start"), pair.alias("pair")))
    # Rows per (product, direction) pull, counted on the loading pass (K8).
    pairs = request_pairs(list(products))
    obs = Observation("cdr_pairs")
    raw = raw.observe(obs, *[F.count_if(F.col(f"{ORDINAL}.pair") == i).alias(f"{p}/{d or 'n/a'}")
                             for i, (p, d) in enumerate(pairs)])
    rows = normalise_cdr(raw)
    out = upsert_table(spark, table_path, _typed(rows, CDR_SCHEMA, [ORDINAL]), list(CDR_KEYS), ordinal=ORDINAL)
    out["pairs"] = obs.get
    return out


def load_usage(spark: SparkSession, usage_pages: str, usage_table: str,
               cost_pages: str | None = None, cost_table: str | None = None,
               multi_line: bool = True, as_of: dt.date | None = None,
               lookback_days: int = USAGE_LOOKBACK_DAYS) -> dict:
    """Usage buckets, then cost buckets, each into its own table.  Landed pulls
    may overlap: the later one (by ``pull=`` folder, else by file name) wins.

    With ``as_of`` only buckets of [as_of - lookback_days, as_of) are loaded,
    the window the pull asks for (the current, partial day excluded).
    """
    how = (multi_line, as_of, lookback_days)
    out = {"usage": load_buckets(spark, usage_pages, usage_table, USAGE_RESULT, flatten_usage, USAGE_SCHEMA, *how)}
    if cost_pages and cost_table:
        out["cost"] = load_buckets(spark, cost_pages, cost_table, COST_RESULT, flatten_cost, COST_SCHEMA, *how)
    return out


def load_buckets(spark: SparkSession, pages: str, table: str, result: T.StructType,
                 flatten: Callable[..., DataFrame], schema: T.StructType, multi_line: bool = True,
                 as_of: dt.date | None = None, lookback_days: int = USAGE_LOOKBACK_DAYS) -> dict:
    """One kind of landed pages into its table; see ``load_usage``."""
    rows = flatten(bucket_scan(spark, pages, result, multi_line, pull=ORDINAL), extra=[ORDINAL])
    if as_of is not None:
        rows = rows.filter(lookback("usage_date", as_of, lookback_days))
    return upsert_table(spark, table, _typed(rows, schema, [ORDINAL]), list(USAGE_KEYS), ordinal=ORDINAL)


def load_invoices(spark: SparkSession, path_or_glob: str, table_path: str) -> dict:
    """Invoice CSVs into the month-partitioned summary; for the same month a
    file later in the order of paths wins."""
    raw = invoice_scan(spark, path_or_glob).withColumn(ORDINAL, F.col("file_path"))
    rows = normalise_invoice(raw, extra=[ORDINAL])
    return upsert_table(spark, table_path, _typed(rows, INVOICE_SCHEMA, [ORDINAL]), list(INVOICE_KEYS),
                        date_col="invoice_month", ordinal=ORDINAL)


__all__ = ["load_cur", "load_cdr", "load_usage", "load_invoices", "USAGE_LOOKBACK_DAYS"]
