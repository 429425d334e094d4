"""Day sums of the billing export, kept current, and month reports from them.

A month report reads every export row of its month.  Here the amounts that all
reports sum are kept per (usage day, local day, service, project).  When a load
replaces days of the export, only those days of it are read and their sums made
again; a report adds up about 32 days of sums and never opens the export.

``usage_day`` is the UTC day of the usage, so that a replaced day owns all its sums;
``local_day`` is the same instant's day in the reports' time zone, so that a month
cuts the sums exactly at local midnight.  The table is partitioned by the month
of the usage day: its days are small, and files of a few rows would cost a
report more than the rows.  Amounts are exact decimals, so sums of sums equal
the report over the rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import REPORT_TZ, month_bounds
from ..functions.numbers import sum_money
from ..operators.tables import day_folders, read_days, write_table
from ..session import scratch_path
from ..sources import files
from . import reports as rp

DAY = "usage_day"
MONTH = "usage_month"
GRAIN = (DAY, "local_day", "service_id", "service", "project_id", "project_number")


def day_sums(bill: DataFrame, fee_skus: Sequence[str] | None = None, tz: str = REPORT_TZ) -> DataFrame:
    """The sums of each (usage day, local day, service, project); excluded cost types are left out.

    Partial sums combine map-side, so a service with a third of the rows sends
    one row a day and task.  ``fee_skus`` are fixed when the sums are made.
    """
    kept = bill.filter((F.col("cost_type") != rp.EXCLUDED_COST_TYPES[0]) & (F.col("cost_type") != rp.EXCLUDED_COST_TYPES[1]))
    at = F.col("usage_start_time").cast("timestamp")
    rows = rp.amounts(kept, fee_skus, [
        F.to_date(at).alias(DAY), F.to_date(F.from_utc_timestamp(at, tz)).alias("local_day"), F.col("service.id").alias("service_id"),
        F.col("project.id").alias("project_id"), F.col("project.number").alias("project_number")])
    return rows.groupBy(*GRAIN).agg(*[sum_money(c).cast("decimal(38,9)").alias(c) for c in rp.AMOUNTS])


def refresh_day_sums(spark: SparkSession, bill: DataFrame, path: str, days: Sequence[dt.date] | None = None,
                     usage_day_col: str | None = None, fee_skus: Sequence[str] | None = None, tz: str = REPORT_TZ) -> None:
    """Make the sums of ``days`` again (all, if not given): those that an upsert replaced.

    With ``usage_day_col`` (see ``cost_breakdown``) only these days of the export
    are read.  A day without rows any more loses its sums.
    """
    if days is not None:
        days = sorted(set(days))
        own = F.col(usage_day_col) if usage_day_col else F.to_date(F.col("usage_start_time").cast("timestamp"))
        bill = bill.filter(own.isin(days))
    if days is None and not files.exists(spark, path):
        # Nothing to keep and nothing to lose: the sums go straight into the new table.
        write_table(day_sums(bill, fee_skus, tz).withColumn(MONTH, F.trunc(DAY, "MM")), path, MONTH, new_table=True)
        return
    # Summed once, into a small staging table: it says which months have rows left.
    staged_path = scratch_path(spark, "day-sums")
    day_sums(bill, fee_skus, tz).withColumn(MONTH, F.trunc(DAY, "MM")).write.parquet(staged_path)
    fresh = spark.read.parquet(staged_path)
    if days is None:
        files.delete(spark, path)
        write_table(fresh, path, MONTH)
    else:
        touched = sorted({d.replace(day=1) for d in days})
        old = read_days(spark, path, touched, MONTH)
        whole = fresh if old is None else fresh.unionByName(old.filter(~F.col(DAY).isin(days)).select(*fresh.columns))
        left = {str(r[0]) for r in whole.select(MONTH).distinct().collect()}
        gone = [f for f in day_folders(spark, path, touched, MONTH) if f.rsplit("=", 1)[1] not in left]
        if left:
            write_table(whole, path, MONTH)
        for folder in gone:
            files.delete(spark, folder)
    files.delete(spark, staged_path)


def cost_from_day_sums(sums: DataFrame, as_of: dt.date, *, month_offset: int = 0, projects: Sequence[str] | None = None,
                       services: Sequence[str] | None = None, limit: int | None = rp.TOP_N) -> DataFrame:
    """:func:`~costframe.plans.reports.cost_breakdown` from day sums: Q1 to Q3 and Q7, D12 with the sums' fee SKUs."""
    lo, hi = month_bounds(as_of, month_offset)
    pred = (F.col("local_day") >= F.lit(lo)) & (F.col("local_day") < F.lit(hi))
    pred = pred & (F.col(DAY) >= F.lit(lo - dt.timedelta(days=1))) & (F.col(DAY) <= F.lit(hi))
    pred = pred & (F.col(MONTH) >= F.lit(month_bounds(lo, -1)[0])) & (F.col(MONTH) <= F.lit(hi))
    if projects is not None:
        pred = pred & (F.col("project_id").isin(list(projects)) | F.col("project_number").isin(list(projects)))
    if services is not None:
        pred = pred & F.col("service_id").isin(list(services))
    agg = sums.filter(pred).groupBy("service").agg(*[F.sum(c).cast("decimal(38,9)").alias(c) for c in rp.AMOUNTS])
    return rp._report(agg, limit)
