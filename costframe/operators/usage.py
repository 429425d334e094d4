"""Usage and cost buckets (nested JSON pages) -> flat keyed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import dimension_key
from ..functions.numbers import strict_double

# Result fields hashed (in this order) into a usage row's key.
USAGE_DIMENSION_FIELDS = ["account_id", "api_key_id", "workspace_id", "service_account_id",
                          "model", "service_tier", "context_window", "inference_geo"]
# Result fields hashed (in this order) into a cost row's key.
COST_DIMENSION_FIELDS = ["workspace_id", "description", "cost_type", "token_type",
                         "model", "service_tier", "context_window", "inference_geo"]
USAGE_KEYS = ("usage_date", "record_id")


def _explode_results(buckets: DataFrame, extra: list[str]) -> DataFrame:
    # explode (not explode_outer): a bucket with no results yields no rows.
    return buckets.select(
        F.col("starting_at"), F.col("ending_at"), *[F.col(c) for c in extra],
        F.explode("results").alias("r"))


def flatten_usage(buckets: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """One row per bucket result; optional sub-records flatten to NULL fields."""
    extra = extra or []
    rows = _explode_results(buckets, extra)
    day_text = F.substring("starting_at", 1, 10)
    r = F.col("r")
    return rows.select(
        day_text.cast("date").alias("usage_date"),
        dimension_key(day_text, [r[f] for f in USAGE_DIMENSION_FIELDS]).alias("record_id"),
        F.to_timestamp("starting_at").alias("bucket_start"),
        F.to_timestamp("ending_at").alias("bucket_end"),
        *[r[f].alias(f) for f in USAGE_DIMENSION_FIELDS],
        r["uncached_input_tokens"].alias("uncached_input_tokens"),
        r["cache_read_input_tokens"].alias("cache_read_input_tokens"),
        r["cache_creation"]["ephemeral_5m_input_tokens"].alias("cache_creation_ephemeral_5m_input_tokens"),
        r["cache_creation"]["ephemeral_1h_input_tokens"].alias("cache_creation_ephemeral_1h_input_tokens"),
        r["output_tokens"].alias("output_tokens"),
        r["server_tool_use"]["web_search_requests"].alias("web_search_requests"),
        *[F.col(c) for c in extra],
    )


def flatten_cost(buckets: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """One row per cost result; ``amount`` text must parse or the job fails."""
    extra = extra or []
    rows = _explode_results(buckets, extra)
    day_text = F.substring("starting_at", 1, 10)
    r = F.col("r")
    return rows.select(
        day_text.cast("date").alias("usage_date"),
        dimension_key(day_text, [r[f] for f in COST_DIMENSION_FIELDS]).alias("record_id"),
        F.to_timestamp("starting_at").alias("bucket_start"),
        F.to_timestamp("ending_at").alias("bucket_end"),
        *[r[f].alias(f) for f in ["workspace_id", "description", "cost_type", "token_type", "model",
                                  "service_tier", "context_window", "inference_geo", "currency"]],
        strict_double(r["amount"], "cost amount").alias("amount_usd"),
        *[F.col(c) for c in extra],
    )
