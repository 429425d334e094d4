"""Declared schemas of the five target tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

from .operators.cur import CUR_COLUMNS

_KIND = {"str": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(),
         "float": T.DoubleType()}


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


CUR_SCHEMA = T.StructType(
    [_f("usage_date", T.DateType(), False), _f("line_item_id", T.StringType(), False)]
    + [_f(dst, _KIND[kind]) for _, dst, kind in CUR_COLUMNS])

CDR_SCHEMA = T.StructType([
    _f("usage_date", T.DateType(), False),
    _f("record_id", T.StringType(), False),
    _f("product", T.StringType(), False),
    _f("direction", T.StringType()),
    _f("category", T.StringType(), False),
    _f("total_price", T.DoubleType()),
    _f("currency", T.StringType()),
    _f("network", T.StringType()),
    _f("country", T.StringType()),
    _f("status", T.StringType()),
    _f("raw", T.StringType()),
])

USAGE_SCHEMA = T.StructType(
    [_f("usage_date", T.DateType(), False), _f("record_id", T.StringType(), False),
     _f("bucket_start", T.TimestampType()), _f("bucket_end", T.TimestampType())]
    + [_f(c, T.StringType()) for c in ["account_id", "api_key_id", "workspace_id", "service_account_id",
                                      "model", "service_tier", "context_window", "inference_geo"]]
    + [_f(c, T.LongType()) for c in ["uncached_input_tokens", "cache_read_input_tokens",
                                    "cache_creation_ephemeral_5m_input_tokens",
                                    "cache_creation_ephemeral_1h_input_tokens", "output_tokens",
                                    "web_search_requests"]])

COST_SCHEMA = T.StructType(
    [_f("usage_date", T.DateType(), False), _f("record_id", T.StringType(), False),
     _f("bucket_start", T.TimestampType()), _f("bucket_end", T.TimestampType())]
    + [_f(c, T.StringType()) for c in ["workspace_id", "description", "cost_type", "token_type", "model",
                                      "service_tier", "context_window", "inference_geo", "currency"]]
    + [_f("amount_usd", T.DoubleType())])

INVOICE_SCHEMA = T.StructType([
    _f("invoice_month", T.DateType(), False),
    _f("service_description", T.StringType(), False),
    _f("service_id", T.StringType(), False),
    _f("list_cost", T.DoubleType()),
    _f("negotiated_savings", T.DoubleType()),
    _f("savings_programmes", T.DoubleType()),
    _f("other_savings", T.DoubleType()),
    _f("unrounded_subtotal", T.DoubleType()),
    _f("subtotal", T.DoubleType()),
    _f("percent_change_vs_previous", T.StringType()),
])


def required(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
