"""Calendar-month cost reports.

Every report is one lazy plan: scan -> filter (month bounds are literals, so
they reach the scan as pushed / partition filters) -> per-row derivations ->
one hash aggregate (partial aggregation before the shuffle, so the shuffle
carries one row per group per task) -> top-k.  No report collects rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.credits import cud_credits, other_savings
from ..functions.dates import REPORT_TZ, date_in_month, instant_in_month, month_bounds
from ..functions.numbers import finish, round_sum2, sum_money

# Cost types a report leaves out.
EXCLUDED_COST_TYPES = ("tax", "adjustment")
# Fixed value: line item type the cost-and-usage reports leave out.
EXCLUDED_LINE_ITEM_TYPE = "Tax"
TOP_N = 10

BREAKDOWN_COLUMNS = ["Service Description", "Cost", "Negotiated savings",
                     "Savings programmes", "Other savings", "Subtotal"]


def _top(df: DataFrame, value: str, key: str, limit: int | None) -> DataFrame:
    # Ties on the value are broken by the group key so the top-k is stable.
    ordered = df.orderBy(F.col(f"`{value}`").desc_nulls_last(), F.col(f"`{key}`").asc_nulls_last())
    return ordered if limit is None else ordered.limit(limit)


def cost_breakdown(bill: DataFrame, as_of: dt.date, *, month_offset: int = 0,
                   projects: Sequence[str] | None = None,
                   services: Sequence[str] | None = None,
                   fee_skus: Sequence[str] | None = None,
                   tz: str = REPORT_TZ, limit: int | None = TOP_N,
                   usage_day_col: str | None = None) -> DataFrame:
    """Cost / savings / subtotal per service for one local calendar month.

    * Q1: defaults (all services, current month, top 10).
    * Q2 / Q3: ``projects`` (matched against project id *or* number) and
      ``services`` scope; Q3 passes ``limit=None``.
    * Q7: ``month_offset=-1`` (a month in arrears).
    * D12: ``fee_skus`` moves the cost of those SKUs out of Cost into
      Savings programmes (the commitment fee); without it the fee is 0.

    ``usage_day_col`` names a column that holds the UTC day of
    ``usage_start_time``, if the table is partitioned by it.  Never name an
    export or ingestion day: rows arrive days late, and would be left out.
    """
    ts_type = bill.schema["usage_start_time"].dataType
    pred = ((F.col("cost_type") != EXCLUDED_COST_TYPES[0])
            & (F.col("cost_type") != EXCLUDED_COST_TYPES[1])
            & instant_in_month("usage_start_time", ts_type, as_of, month_offset, tz))
    if usage_day_col is not None:
        # Day-partitioned table: the UTC days that can hold instants of the
        # local month, as a partition filter (prunes whole day folders).
        lo, hi = month_bounds(as_of, month_offset)
        pred = pred & (F.col(usage_day_col) >= F.lit(lo - dt.timedelta(days=1))) & (
            F.col(usage_day_col) <= F.lit(hi))
    if projects is not None:
        ids = list(projects)
        pred = pred & (F.col("project.id").isin(ids) | F.col("project.number").isin(ids))
    if services is not None:
        pred = pred & F.col("service.id").isin(list(services))

    agg = amounts(bill.filter(pred), fee_skus).groupBy("service").agg(*[sum_money(c).alias(c) for c in AMOUNTS])
    return _report(agg, limit)


#: The summed amounts that every report is made of.
AMOUNTS = ("s_list", "s_fee", "s_neg", "s_cud_sav", "s_cud", "s_other", "s_cost")


def amounts(bill: DataFrame, fee_skus: Sequence[str] | None = None, keep: Sequence[Column] = ()) -> DataFrame:
    """Each export row's service and the amounts that reports sum (``AMOUNTS``), with the columns to ``keep``."""
    eff = F.coalesce(F.col("cost_at_effective_price_default"), F.col("cost"))
    fee = (F.when(F.col("sku.id").isin(list(fee_skus)), F.col("cost")).otherwise(F.lit(0.0))
           if fee_skus else F.lit(0))
    return bill.select(
        *keep,
        F.col("service.description").alias("service"),
        F.col("cost_at_list").alias("s_list"),
        F.col("cost").alias("s_cost"),
        fee.alias("s_fee"),
        (F.col("cost") - eff).alias("s_cud_sav"),
        (eff - F.col("cost_at_list")).alias("s_neg"),
        cud_credits("credits").alias("s_cud"),
        other_savings("credits").alias("s_other"),
    )


def _report(agg: DataFrame, limit: int | None) -> DataFrame:
    out = agg.select(
        F.col("service").alias("Service Description"),
        finish(F.col("s_list") - F.col("s_fee")).alias("Cost"),
        finish("s_neg").alias("Negotiated savings"),
        finish(F.col("s_fee") + F.col("s_cud_sav") + F.col("s_cud")).alias("Savings programmes"),
        finish("s_other").alias("Other savings"),
        finish(F.col("s_cost") + F.col("s_cud") + F.col("s_other")).alias("Subtotal"),
    )
    return _top(out, "Subtotal", "Service Description", limit)


def credit_columns(bill: DataFrame) -> DataFrame:
    """Per-row credit sums next to the row's scope (A5, F8, J2; no shuffle)."""
    return bill.select(
        F.col("service.id").alias("service_id"),
        F.col("project.id").alias("project_id"),
        F.col("usage_start_time"),
        F.col("cost_type"),
        F.coalesce(F.size("credits"), F.lit(-1)).alias("n_credits"),
        cud_credits("credits").alias("cud_credits"),
        other_savings("credits").alias("other_savings"),
    )


def credit_columns_lateral(spark, bill: DataFrame) -> DataFrame:
    """The same per-row credit sums, written as SQL over the unnested array.

    A cross-check of :func:`credit_columns`.  Each row gets an id, its
    credits are unnested (LATERAL VIEW OUTER keeps rows without credits)
    and summed back per row id.  The id is unique, so the shuffle cannot be
    skewed, and a row's credits sit next to each other, so partial
    aggregation folds them before the shuffle.  (A correlated scalar
    subquery would be decorrelated into a join on the credits array itself,
    where identical arrays, NULL included, form hot keys.)
    """
    from ..functions.credits import CUD_CREDIT_TYPES, OTHER_CREDIT_TYPES

    cud = ", ".join(f"'{t}'" for t in CUD_CREDIT_TYPES)
    oth = ", ".join(f"'{t}'" for t in OTHER_CREDIT_TYPES)
    return spark.sql(f"""
        SELECT b.service.id AS service_id, b.project.id AS project_id, b.usage_start_time,
               b.cost_type, coalesce(size(b.credits), -1) AS n_credits,
               CAST(coalesce(sum(CASE WHEN c.type IN ({cud}) THEN CAST(c.amount AS DECIMAL(26,9)) END), 0)
                    AS DECIMAL(26,9)) AS cud_credits,
               CAST(coalesce(sum(CASE WHEN c.type IN ({oth}) THEN CAST(c.amount AS DECIMAL(26,9)) END), 0)
                    AS DECIMAL(26,9)) AS other_savings
        FROM {{bill}} b LATERAL VIEW OUTER explode(b.credits) x AS c
        GROUP BY b._row, b.service.id, b.project.id, b.usage_start_time, b.cost_type,
                 coalesce(size(b.credits), -1)
    """, bill=bill.withColumn("_row", F.monotonically_increasing_id()))


# ---------------------------------------------------------------- flat tables
def cur_cost_by_service(cur: DataFrame, as_of: dt.date, *, month_offset: int = 0,
                        label: str = "Service Description", effective: bool = False,
                        limit: int | None = TOP_N) -> DataFrame:
    """Unblended cost per product for a DATE month (Q4; Q5 with ``month_offset=-1``
    and ``label='Service'``; D6 with ``effective=True``)."""
    rows = cur.filter((F.col("line_item_type") != EXCLUDED_LINE_ITEM_TYPE)
                      & date_in_month("usage_date", as_of, month_offset))
    aggs = [round_sum2("line_item_unblended_cost").alias("Cost")]
    if effective:
        aggs += [round_sum2("reservation_effective_cost").alias("Reservation effective cost"),
                 round_sum2("savings_plan_effective_cost").alias("Savings plan effective cost")]
    out = rows.groupBy(F.col("product_name").alias(label)).agg(*aggs)
    return _top(out, "Cost", label, limit)


def cur_cost_by_environment(cur: DataFrame, as_of: dt.date, *, month_offset: int = 0) -> DataFrame:
    """Cost and line-item count per environment tag."""
    rows = cur.filter((F.col("line_item_type") != EXCLUDED_LINE_ITEM_TYPE)
                      & date_in_month("usage_date", as_of, month_offset))
    return rows.groupBy(F.col("resource_tags_environment").alias("environment")).agg(
        round_sum2("line_item_unblended_cost").alias("Cost"),
        F.count(F.lit(1)).alias("line_items"),
    )


def cdr_cost_by_category(cdr: DataFrame, as_of: dt.date, *, month_offset: int = 0) -> DataFrame:
    """EUR cost per category for a DATE month, all categories (Q6)."""
    rows = cdr.filter(date_in_month("usage_date", as_of, month_offset))
    out = rows.groupBy(F.col("category").alias("Service Description")).agg(
        round_sum2("total_price").alias("Cost"))
    return _top(out, "Cost", "Service Description", None)


def sources_side_by_side(bill: DataFrame, cur: DataFrame, cdr: DataFrame, *,
                         bill_as_of: dt.date, cur_as_of: dt.date, cdr_as_of: dt.date,
                         usage_day_col: str | None = None) -> DataFrame:
    """One row per (source, currency, service); currencies are never summed
    together (D11).  Each source keeps its own month window.  ``usage_day_col``
    is the export's, as in :func:`cost_breakdown`."""
    gcp = cost_breakdown(bill, bill_as_of, limit=None, usage_day_col=usage_day_col).select(
        F.lit("gcp").alias("source"), F.lit("USD").alias("currency"),
        F.col("Service Description").alias("service"),
        F.round(F.col("Subtotal"), 2).cast(T.DoubleType()).alias("cost"))
    aws = cur_cost_by_service(cur, cur_as_of, limit=None).select(
        F.lit("aws").alias("source"), F.lit("USD").alias("currency"),
        F.col("Service Description").alias("service"), F.col("Cost").alias("cost"))
    tel = cdr_cost_by_category(cdr, cdr_as_of).select(
        F.lit("cdr").alias("source"), F.lit("EUR").alias("currency"),
        F.col("Service Description").alias("service"), F.col("Cost").alias("cost"))
    return gcp.unionByName(aws).unionByName(tel)


# ---------------------------------------------------------------- usage
TOKEN_INPUT_COLUMNS = ("uncached_input_tokens", "cache_read_input_tokens",
                       "cache_creation_ephemeral_5m_input_tokens",
                       "cache_creation_ephemeral_1h_input_tokens")


def total_input_tokens() -> Column:
    """uncached + cache read + both cache creations, missing parts as 0."""
    total = None
    for c in TOKEN_INPUT_COLUMNS:
        part = F.coalesce(F.col(c), F.lit(0).cast("bigint"))
        total = part if total is None else total + part
    return total


def usage_input_by_day(usage: DataFrame) -> DataFrame:
    return usage.groupBy("usage_date", "model").agg(
        F.sum(total_input_tokens()).alias("total_input_tokens"),
        F.sum(F.coalesce(F.col("output_tokens"), F.lit(0).cast("bigint"))).alias("output_tokens"))


# Bucket widths and the time unit each truncates to.
BUCKET_WIDTHS = {"1m": "minute", "1h": "hour", "1d": "day"}


def rollup(df: DataFrame, ts_col: str, width: str, dims: Sequence[str],
           measures: dict[str, Column]) -> DataFrame:
    """Roll rows into ``width`` buckets by the chosen dimensions."""
    unit = BUCKET_WIDTHS[width]
    bucket = F.date_trunc(unit, F.col(ts_col)).alias("bucket_start")
    return df.groupBy(bucket, *dims).agg(*[m.alias(k) for k, m in measures.items()])


__all__ = [
    "BREAKDOWN_COLUMNS", "cost_breakdown", "credit_columns", "credit_columns_lateral",
    "cur_cost_by_service", "cur_cost_by_environment", "cdr_cost_by_category",
    "sources_side_by_side", "usage_input_by_day", "rollup",
]
