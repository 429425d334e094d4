"""Monthly invoice CSV rows -> the invoice summary table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import sum_money, tolerant_double

# Fixed value: the date searched for in a file name; year and month are kept.
FILE_DATE_PATTERN = r"(\d{4})-(\d{2})-\d{2}"
# CSV header -> table column, for the six amounts.
AMOUNT_HEADERS = [
    ("List cost ($)", "list_cost"),
    ("Negotiated savings ($)", "negotiated_savings"),
    ("Savings programmes ($)", "savings_programmes"),
    ("Other savings ($)", "other_savings"),
    ("Unrounded subtotal ($)", "unrounded_subtotal"),
    ("Subtotal ($)", "subtotal"),
]
DESCRIPTION_HEADER = "Service description"
ID_HEADER = "Service ID"
PERCENT_HEADER = "Percent change in subtotal compared to previous period"
# Fixed value: the footer row holding the month's total.
FOOTER_TOTAL_LABEL = "Subtotal"
INVOICE_KEYS = ("invoice_month", "service_id")


def _h(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def invoice_month(file_name: Column) -> Column:
    """First of the month named by the first YYYY-MM-DD in the file name; a
    name without a date fails the job (P18)."""
    y = F.regexp_extract(file_name, FILE_DATE_PATTERN, 1)
    m = F.regexp_extract(file_name, FILE_DATE_PATTERN, 2)
    return F.when(y != "", F.make_date(y.cast("int"), m.cast("int"), F.lit(1))).otherwise(
        F.raise_error(F.concat(F.lit("no YYYY-MM-DD date in invoice file name: "), file_name))
        .cast("date"))


def _trimmed(df: DataFrame, name: str) -> Column:
    return F.trim(F.coalesce(_h(df, name), F.lit("")))


def normalise_invoice(raw: DataFrame, file_col: str = "file_name",
                      extra: list[str] | None = None) -> DataFrame:
    """Typed invoice rows; footer rows (blank Service ID) are dropped.
    ``extra`` passes bookkeeping columns (e.g. a load ordinal) through."""
    sid = _trimmed(raw, ID_HEADER)
    return raw.filter(sid != "").select(
        invoice_month(F.col(file_col)).alias("invoice_month"),
        _trimmed(raw, DESCRIPTION_HEADER).alias("service_description"),
        sid.alias("service_id"),
        *[tolerant_double(_h(raw, h)).alias(c) for h, c in AMOUNT_HEADERS],
        F.nullif(_trimmed(raw, PERCENT_HEADER), F.lit("")).alias("percent_change_vs_previous"),
        *[F.col(c) for c in (extra or [])],
    )


def reconcile_invoice(raw: DataFrame, file_col: str = "file_name",
                      footer_label: str = FOOTER_TOTAL_LABEL) -> DataFrame:
    """Per month: sum of the service rows' subtotals against the footer total.

    One aggregation over all rows of the month; the footer is picked out by a
    conditional sum, so no join is needed.
    """
    sid = _trimmed(raw, ID_HEADER)
    desc = _trimmed(raw, DESCRIPTION_HEADER)
    sub = tolerant_double(_h(raw, "Subtotal ($)"))
    rows = raw.select(invoice_month(F.col(file_col)).alias("invoice_month"),
                      F.when(sid != "", sub).alias("service_sub"),
                      F.when((sid == "") & (desc == footer_label), sub).alias("footer_sub"))
    agg = rows.groupBy("invoice_month").agg(
        sum_money("service_sub").alias("s"),
        sum_money("footer_sub").alias("f"),
        F.count("service_sub").alias("services"))
    diff = F.round(F.col("s") - F.col("f"), 2)
    return agg.select("invoice_month", "services",
                      F.round("s", 2).cast("double").alias("services_subtotal"),
                      F.round("f", 2).cast("double").alias("footer_subtotal"),
                      diff.cast("double").alias("difference"),
                      (diff == 0).alias("matches"))
