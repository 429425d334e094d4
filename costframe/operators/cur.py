"""Cost-and-usage report rows: raw text columns -> typed table columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import blank_to_null, date_prefix
from ..functions.numbers import tolerant_double

# Raw report column, table column, value kind.
CUR_COLUMNS = [
    ("bill/PayerAccountId", "bill_payer_account_id", "str"),
    ("bill/BillingPeriodStartDate", "bill_billing_period_start_date", "date"),
    ("lineItem/UsageAccountId", "line_item_usage_account_id", "str"),
    ("lineItem/LineItemType", "line_item_type", "str"),
    ("lineItem/UsageStartDate", "line_item_usage_start_date", "timestamp"),
    ("lineItem/UsageEndDate", "line_item_usage_end_date", "timestamp"),
    ("lineItem/ProductCode", "line_item_product_code", "str"),
    ("lineItem/UsageType", "line_item_usage_type", "str"),
    ("lineItem/Operation", "line_item_operation", "str"),
    ("lineItem/LineItemDescription", "line_item_description", "str"),
    ("lineItem/UsageAmount", "line_item_usage_amount", "float"),
    ("lineItem/UnblendedRate", "line_item_unblended_rate", "float"),
    ("lineItem/UnblendedCost", "line_item_unblended_cost", "float"),
    ("product/ProductName", "product_name", "str"),
    ("product/servicecode", "product_service_code", "str"),
    ("product/region", "product_region", "str"),
    ("pricing/unit", "pricing_unit", "str"),
    ("reservation/EffectiveCost", "reservation_effective_cost", "float"),
    ("savingsPlan/SavingsPlanEffectiveCost", "savings_plan_effective_cost", "float"),
    ("resourceTags/user:environment", "resource_tags_environment", "str"),
    ("resourceTags/user:transfer:customHostname", "resource_tags_transfer_custom_hostname", "str"),
    ("costCategory/Development", "cost_category_development", "str"),
    ("costCategory/Production", "cost_category_production", "str"),
]

# Raw columns of the two keys.
CUR_DATE_SOURCE = "lineItem/UsageStartDate"
CUR_ID_SOURCE = "identity/LineItemId"
CUR_KEYS = ("usage_date", "line_item_id")


def _raw(df: DataFrame, name: str) -> Column:
    """A raw column by its vendor name, or NULL when the file lacks it."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(None).cast("string")


def _typed(value: Column, kind: str) -> Column:
    if kind == "float":
        return tolerant_double(value)
    if kind == "date":
        return date_prefix(blank_to_null(value))
    if kind == "timestamp":
        return F.to_timestamp(blank_to_null(value))
    return blank_to_null(value)


def normalise_cur(raw: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """One ``select`` from raw report text to the 25 table columns.

    ``usage_date`` is the first ten characters of the usage start; the line
    item id is taken as it is (no blank-to-NULL).  Columns the file lacks are
    NULL.  ``extra`` passes bookkeeping columns (e.g. a load ordinal) through.
    """
    cols = [
        date_prefix(blank_to_null(_raw(raw, CUR_DATE_SOURCE))).alias("usage_date"),
        _raw(raw, CUR_ID_SOURCE).alias("line_item_id"),
    ]
    cols += [_typed(_raw(raw, src), kind).alias(dst) for src, dst, kind in CUR_COLUMNS]
    cols += [F.col(c) for c in (extra or [])]
    return raw.select(*cols)
