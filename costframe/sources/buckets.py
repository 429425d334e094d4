"""Paged usage / cost bucket scan.

Each landed page is the API's JSON response ``{data: [bucket...], has_more,
next_page}``; all buckets of all pages are read with a declared schema (no
inference) and exploded.  Page order does not matter: rows are keyed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import files

USAGE_RESULT = T.StructType(
    [T.StructField(f, T.StringType()) for f in
     ["account_id", "api_key_id", "workspace_id", "service_account_id", "model", "service_tier",
      "context_window", "inference_geo"]]
    + [T.StructField("uncached_input_tokens", T.LongType()),
       T.StructField("cache_read_input_tokens", T.LongType()),
       T.StructField("cache_creation", T.StructType([
           T.StructField("ephemeral_5m_input_tokens", T.LongType()),
           T.StructField("ephemeral_1h_input_tokens", T.LongType())])),
       T.StructField("output_tokens", T.LongType()),
       T.StructField("server_tool_use", T.StructType([
           T.StructField("web_search_requests", T.LongType())]))])

COST_RESULT = T.StructType([T.StructField(f, T.StringType()) for f in
                            ["amount", "currency", "description", "cost_type", "token_type", "model",
                             "service_tier", "context_window", "inference_geo", "workspace_id"]])


def page_schema(result: T.StructType) -> T.StructType:
    bucket = T.StructType([T.StructField("starting_at", T.StringType()),
                           T.StructField("ending_at", T.StringType()),
                           T.StructField("results", T.ArrayType(result))])
    return T.StructType([T.StructField("data", T.ArrayType(bucket)),
                         T.StructField("has_more", T.BooleanType()),
                         T.StructField("next_page", T.StringType())])


def bucket_scan(spark: SparkSession, path: str, result: T.StructType = USAGE_RESULT,
                multi_line: bool = True, pull: str | None = None) -> DataFrame:
    """All buckets of all pages (``multi_line=False`` for one page per line).

    ``pull`` names a column for the pull that a page belongs to (see ``pull_of``).
    A missing folder gives no rows.
    """
    if not files.glob_any(spark, path):
        bucket = page_schema(result)["data"].dataType.elementType
        return spark.createDataFrame([], T.StructType([*bucket.fields, *([T.StructField(pull, T.StringType())] if pull else [])]))
    pages = spark.read.schema(page_schema(result)).option("multiLine", multi_line).json(path)
    more = [pull_of(F.col("_metadata.file_path")).alias(pull)] if pull else []
    return pages.select(F.explode("data").alias("b"), *more).select("b.*", *([pull] if pull else []))


def pull_of(path: Column) -> Column:
    """The pull of a landed page, in an order in which later pulls come last: the
    name of its ``pull=`` folder, or of its file where pulls are single files."""
    folder = F.regexp_extract(path, "/pull=([^/]+)/", 1)
    return F.when(folder != "", folder).otherwise(F.element_at(F.split(path, "/"), -1))
