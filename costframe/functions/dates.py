"""Calendar windows: report months, billing periods, lookbacks.

Reports take an ``as_of`` date and turn it into literal bounds, so Catalyst
sees constants: DATE bounds become partition filters / Parquet pushed filters,
TIMESTAMP bounds become pushed filters on the scan.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the calendar the reports are cut in.
REPORT_TZ = "Europe/London"
# Fixed value: days into a new month during which the previous billing period
# is still re-read (restatement window).
RESTATEMENT_WINDOW_DAYS = 7


def month_start(day: dt.date, offset: int = 0) -> dt.date:
    """First day of ``day``'s month shifted by ``offset`` months."""
    m = day.year * 12 + (day.month - 1) + offset
    return dt.date(m // 12, m % 12 + 1, 1)


def month_bounds(as_of: dt.date, offset: int = 0) -> tuple[dt.date, dt.date]:
    """Half-open [first day, first day of next month) of a report month."""
    return month_start(as_of, offset), month_start(as_of, offset + 1)


def today_in(tz: str = REPORT_TZ) -> dt.date:
    return dt.datetime.now(ZoneInfo(tz)).date()


def local_midnight_utc(day: dt.date, tz: str = REPORT_TZ) -> dt.datetime:
    """The UTC instant of midnight at the start of ``day`` in ``tz`` (naive UTC)."""
    local = dt.datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(tz))
    return local.astimezone(dt.timezone.utc).replace(tzinfo=None)


def _instant_literal(utc_naive: dt.datetime, dtype: T.DataType) -> Column:
    text = utc_naive.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(dtype, T.TimestampNTZType):
        # NTZ columns hold the UTC wall clock.
        return F.expr(f"TIMESTAMP_NTZ '{text}'")
    return F.expr(f"TIMESTAMP '{text} UTC'")


def date_in_month(col: Column | str, as_of: dt.date, offset: int = 0) -> Column:
    """DATE column inside the report month."""
    c = F.col(col) if isinstance(col, str) else col
    lo, hi = month_bounds(as_of, offset)
    return (c >= F.lit(lo)) & (c < F.lit(hi))


def instant_in_month(col: str, dtype: T.DataType, as_of: dt.date, offset: int = 0,
                     tz: str = REPORT_TZ) -> Column:
    """TIMESTAMP column inside the report month, bounds at local midnight."""
    lo, hi = month_bounds(as_of, offset)
    c = F.col(col)
    return ((c >= _instant_literal(local_midnight_utc(lo, tz), dtype))
            & (c < _instant_literal(local_midnight_utc(hi, tz), dtype)))


def local_month(col: Column | str, dtype: T.DataType, tz: str = REPORT_TZ) -> Column:
    """First day (DATE) of the local calendar month an instant falls in."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.TimestampNTZType):
        local = F.convert_timezone(F.lit("UTC"), F.lit(tz), c)
    else:
        local = F.from_utc_timestamp(c, tz)
    return F.trunc(F.to_date(local), "MM")


def billing_period(day: Column | str) -> Column:
    """Label ``YYYYMMDD-YYYYMMDD`` of the month holding ``day`` (S3)."""
    d = F.col(day) if isinstance(day, str) else day
    start = F.trunc(d, "MM")
    return F.concat(F.date_format(start, "yyyyMMdd"), F.lit("-"),
                    F.date_format(F.add_months(start, 1), "yyyyMMdd"))


def billing_period_label(day: dt.date) -> str:
    lo, hi = month_bounds(day)
    return f"{lo:%Y%m%d}-{hi:%Y%m%d}"


def periods_to_check(day: Column | str, window_days: int = RESTATEMENT_WINDOW_DAYS) -> Column:
    """Current period, plus the previous one while day-of-month <= window."""
    d = F.col(day) if isinstance(day, str) else day
    current = billing_period(d)
    previous = billing_period(F.add_months(F.trunc(d, "MM"), -1))
    return F.when(F.dayofmonth(d) <= window_days, F.array(current, previous)).otherwise(
        F.array(current))


def period_labels_to_check(as_of: dt.date, window_days: int = RESTATEMENT_WINDOW_DAYS) -> list[str]:
    """Driver-side form of :func:`periods_to_check` for choosing folders to scan."""
    labels = [billing_period_label(as_of)]
    if as_of.day <= window_days:
        labels.append(billing_period_label(month_start(as_of, -1)))
    return labels


def lookback(col: Column | str, as_of: dt.date, days: int) -> Column:
    """[as_of - days, as_of): whole past days only, today's partial day excluded."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= F.lit(as_of - dt.timedelta(days=days))) & (c < F.lit(as_of))
