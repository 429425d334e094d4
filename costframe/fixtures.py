"""Cost-shaped views derived from the driver's tables.

The reference ships no data.  These views re-shape the TPC-H-like test tables
into the five source shapes the library works on, so that a Spark job and a
DuckDB oracle see the same input (the SQL twins live in ``oracle.py``).
Each view is a lazy DataFrame over the Parquet files, so Catalyst prunes the
columns and pushes filters from the queries built on top of it.

| view          | built from        | shape                                        |
|---------------|-------------------|----------------------------------------------|
| bill          | lineitem x part   | live billing export (structs, credits array) |
| cur           | lineitem x part   | normalised cost-and-usage table              |
| cur_raw       | cur               | raw cost report text columns                 |
| cdr           | events            | normalised call/message records              |
| cdr_raw       | events            | raw report rows as landed per product/dir.   |
| usage_buckets | events            | paged usage buckets (nested results)         |
| cost_buckets  | events            | paged cost buckets (nested results)          |
| invoice_raw   | orders            | monthly per-service invoice CSV rows         |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.numbers import ROW_DECIMAL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Fixed value: the service that the export has no price for.
UNPRICED = "Brand#2"


def _lineitem_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    # Equi-join on the part key; Catalyst/AQE choose broadcast only when the
    # part side is measured under the broadcast threshold.
    return li.join(part, li.l_partkey == part.p_partkey, "inner")


def _hours(n: F.Column) -> F.Column:
    return F.make_dt_interval(F.lit(0), n, F.lit(0), F.lit(0))


# ---------------------------------------------------------------- bill
CREDIT_TYPE = T.ArrayType(T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
]))


# An unlisted credit type and the ten listed ones.
CREDIT_NAMES = ["OTHER_UNLISTED", "COMMITTED_USAGE_DISCOUNT", "COMMITTED_USAGE_DISCOUNT_DOLLAR_BASE",
                "FEE_UTILIZATION_OFFSET", "CREDIT_TYPE_UNSPECIFIED", "PROMOTION", "SUSTAINED_USAGE_DISCOUNT",
                "DISCOUNT", "FREE_TIER", "SUBSCRIPTION_BENEFIT", "RESELLER_MARGIN"]


def bill(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _lineitem_part(spark, sf_dir)
    price, disc, tax, qty = (F.col("l_extendedprice"), F.col("l_discount"),
                             F.col("l_tax"), F.col("l_quantity"))
    flag = F.col("l_returnflag")
    price = F.when(F.col("p_brand") != UNPRICED, price)
    credits = (
        F.when(flag == "A", F.array(
            F.struct(F.lit("COMMITTED_USAGE_DISCOUNT").alias("type"), (-tax * qty).alias("amount")),
            F.struct(F.lit("PROMOTION").alias("type"), (-disc * qty).alias("amount"))))
        .when((flag == "R") & (F.col("l_linenumber") == 6), F.array().cast(CREDIT_TYPE))
        .when(flag == "R", F.array(F.struct(
            F.get(F.array(*[F.lit(t) for t in CREDIT_NAMES]), (F.col("l_orderkey") % len(CREDIT_NAMES)).cast("int")).alias("type"),
            F.when(F.col("l_linenumber") != 5, -disc * qty).alias("amount"))))
        .otherwise(F.lit(None).cast(CREDIT_TYPE))
    )
    line = F.col("l_linenumber")
    return j.select(
        F.struct(F.col("p_brand").alias("id"), F.col("p_brand").alias("description")).alias("service"),
        F.struct(F.col("p_type").alias("id"), F.col("p_type").alias("description")).alias("sku"),
        F.struct(F.col("l_suppkey").cast("string").alias("id"),
                 (F.col("l_suppkey") + 1000).cast("string").alias("number")).alias("project"),
        price.alias("cost_at_list"),
        F.when(flag == "N", F.lit(None).cast("double"))
         .otherwise(price * (1 - disc)).alias("cost_at_effective_price_default"),
        (price * (1 - disc) * (1 - tax)).alias("cost"),
        F.when(line == 1, "tax").when(line == 2, "adjustment")
         .when(line == 3, F.lit(None).cast("string")).otherwise("regular").alias("cost_type"),
        (F.col("l_shipdate") + _hours(qty.cast("int") % 24)).alias("usage_start_time"),
        credits.alias("credits"),
        F.lit("USD").alias("currency"),
    )


# ---------------------------------------------------------------- cur
def cur(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _lineitem_part(spark, sf_dir)
    price, disc, flag = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_returnflag")
    line = F.col("l_linenumber")
    ship = F.col("l_shipdate")
    return j.select(
        F.to_date(ship).alias("usage_date"),
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("line_item_id"),
        F.concat(F.lit("payer-"), (F.col("l_suppkey") % 3).cast("string")).alias("bill_payer_account_id"),
        F.trunc(F.to_date(ship), "MM").alias("bill_billing_period_start_date"),
        F.col("l_suppkey").cast("string").alias("line_item_usage_account_id"),
        F.when(line == 1, "Tax").when(line == 3, F.lit(None).cast("string"))
         .otherwise("Usage").alias("line_item_type"),
        ship.alias("line_item_usage_start_date"),
        (ship + _hours(F.lit(1))).alias("line_item_usage_end_date"),
        F.col("p_brand").alias("line_item_product_code"),
        F.concat(F.col("p_type"), F.lit("-Usage")).alias("line_item_usage_type"),
        F.col("l_linestatus").alias("line_item_operation"),
        F.concat(F.lit("qty "), F.col("l_quantity").cast("int").cast("string")).alias("line_item_description"),
        F.col("l_quantity").alias("line_item_usage_amount"),
        (price / F.col("l_quantity")).alias("line_item_unblended_rate"),
        price.alias("line_item_unblended_cost"),
        F.col("p_brand").alias("product_name"),
        F.col("p_type").alias("product_service_code"),
        F.when(line == 2, F.lit(None).cast("string")).otherwise("eu-west-2").alias("product_region"),
        F.lit("Hrs").alias("pricing_unit"),
        F.when(flag == "R", price * (1 - disc)).alias("reservation_effective_cost"),
        F.when(flag == "A", price * (1 - disc)).alias("savings_plan_effective_cost"),
        F.col("p_type").alias("resource_tags_environment"),
        F.lit(None).cast("string").alias("resource_tags_transfer_custom_hostname"),
        F.when(F.col("p_type") == "PROMO", "yes").alias("cost_category_development"),
        F.when(F.col("p_type") != "PROMO", "yes").alias("cost_category_production"),
    )


def _iso_z(ts: F.Column) -> F.Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def cur_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cur view as raw report text: vendor column names, '' for NULL."""
    from .operators.cur import CUR_COLUMNS  # raw name -> target name, kind

    c = cur(spark, sf_dir)
    exprs = []
    for raw, target, kind in CUR_COLUMNS:
        v = F.col(target)
        if kind == "date":
            text = F.concat(F.date_format(v, "yyyy-MM-dd"), F.lit("T00:00:00Z"))
        elif kind == "timestamp":
            text = _iso_z(v)
        else:
            text = v.cast("string")
        exprs.append(F.coalesce(text, F.lit("")).alias(raw))
    exprs.append(F.col("line_item_id").alias("identity/LineItemId"))
    return c.select(*exprs)


# ---------------------------------------------------------------- cdr
def _cdr_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    product = (F.when(et == "view", "SMS").when(et.isin("click", "signup"), "VOICE-CALL")
               .when(et == "purchase", "VOICE-TTS").when(et == "error", "WEBSOCKET-CALL"))
    req_dir = (F.when(et.isin("view", "signup"), "inbound").when(et == "click", "outbound")
               .otherwise(F.lit(None).cast("string")))
    row_dir = (F.when((et == "view") & (F.col("user_id") % 5 == 0), "outbound")
               .when(et == "click", "outbound").otherwise(""))
    price_text = F.when(F.col("event_id") % 97 == 0, F.lit("n/a")).otherwise(
        F.col("value").cast("string"))
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        product.alias("product"), req_dir.alias("req_direction"),
        row_dir.alias("row_direction"), price_text.alias("price_text"),
    )


def cdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised call/message table, as normalise_cdr(cdr_raw) would store it."""
    from .operators.cdr import category_for

    b = _cdr_base(spark, sf_dir)
    return b.select(
        F.to_date("ts").alias("usage_date"),
        F.col("event_id").cast("string").alias("record_id"),
        "product",
        F.coalesce(F.nullif(F.col("row_direction"), F.lit("")), F.col("req_direction")).alias("direction"),
        category_for(F.col("product"), F.col("req_direction")).alias("category"),
        F.when(F.col("price_text") == "n/a", F.lit(None).cast("double"))
         .otherwise(F.col("value")).alias("total_price"),
        F.when(F.col("product") == "SMS", "").otherwise("EUR").alias("currency"),
        F.concat(F.lit("net-"), (F.col("user_id") % 4).cast("string")).alias("network"),
        F.lit("GB").alias("country"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"),
        F.col("props").alias("raw"),
    )


def cdr_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw report rows as landed: every text column, plus the request's
    product / direction / start (the landing folder's partition values)."""
    b = _cdr_base(spark, sf_dir)
    et = F.col("event_type")
    eid = F.col("event_id").cast("string")
    uuid_row = (et == "error") & (F.col("user_id") % 3 == 0)
    no_date = (et == "purchase") & (F.col("user_id") % 7 == 0)
    blank = F.lit("")
    return b.select(
        "product",
        F.col("req_direction").alias("direction_requested"),
        F.concat(F.date_format(F.to_date("ts"), "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("request_start"),
        F.when(et == "view", eid).otherwise(blank).alias("message_id"),
        F.when(et.isin("click", "signup") | ((et == "error") & ~uuid_row), eid)
         .otherwise(blank).alias("call_id"),
        F.when(uuid_row, eid).otherwise(blank).alias("uuid"),
        F.when(et == "purchase", eid).otherwise(blank).alias("id"),
        F.when(et == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(blank).alias("date_received"),
        F.when(et.isin("click", "signup", "error"), _iso_z(F.col("ts"))).otherwise(blank).alias("date_start"),
        F.when((et == "purchase") & ~no_date, _iso_z(F.col("ts"))).otherwise(blank).alias("creation_date"),
        F.col("row_direction").alias("direction"),
        F.col("price_text").alias("total_price"),
        F.when(F.col("product") == "SMS", "").otherwise("EUR").alias("currency"),
        F.concat(F.lit("net-"), (F.col("user_id") % 4).cast("string")).alias("network"),
        F.lit("GB").alias("country"),
        F.when(et == "error", "failed").otherwise("ok").alias("status"),
        F.col("props").alias("client_ref"),
    )


# ---------------------------------------------------------------- buckets
def _bucket_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    # Pre-aggregate: one result per (day, event_type, user parity) before any
    # nesting, so a day's bucket holds at most 10 results.
    return (ev.groupBy(F.to_date("ts").alias("day"), F.col("event_type"),
                       (F.col("user_id") % 2).alias("parity"))
              .agg(F.count(F.lit(1)).alias("n"),
                   F.sum(F.floor("value").cast("bigint")).alias("out_tokens"),
                   F.count_if(F.col("value") > 100).alias("big")))


def _bucket_frame(results: DataFrame, struct_col: F.Column) -> DataFrame:
    day = F.col("day")
    return (results.groupBy("day").agg(F.collect_list(struct_col).alias("results"))
            .select(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("starting_at"),
                    F.concat(F.date_format(F.date_add(day, 1), "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("ending_at"),
                    "results"))


def usage_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _bucket_results(spark, sf_dir)
    et = F.col("event_type")
    s = F.struct(
        F.lit("acct-1").alias("account_id"),
        F.lit(None).cast("string").alias("api_key_id"),
        F.when(F.col("parity") == 0, F.lit(None).cast("string")).otherwise("w1").alias("workspace_id"),
        F.lit(None).cast("string").alias("service_account_id"),
        et.alias("model"),
        F.lit("standard").alias("service_tier"),
        F.lit("0-200k").alias("context_window"),
        F.lit("global").alias("inference_geo"),
        F.col("n").alias("uncached_input_tokens"),
        F.col("n").alias("cache_read_input_tokens"),
        F.when(et == "error", F.lit(None).cast("struct<ephemeral_5m_input_tokens:bigint,ephemeral_1h_input_tokens:bigint>"))
         .otherwise(F.struct(F.col("n").alias("ephemeral_5m_input_tokens"),
                             F.col("n").alias("ephemeral_1h_input_tokens"))).alias("cache_creation"),
        F.col("out_tokens").alias("output_tokens"),
        F.when(et == "view", F.lit(None).cast("struct<web_search_requests:bigint>"))
         .otherwise(F.struct(F.col("big").alias("web_search_requests"))).alias("server_tool_use"),
    )
    return _bucket_frame(r, s)


def cost_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _bucket_results(spark, sf_dir)
    et = F.col("event_type")
    s = F.struct(
        F.col("n").cast("string").alias("amount"),
        F.lit("USD").alias("currency"),
        F.concat(et, F.lit(" tokens")).alias("description"),
        F.lit("tokens").alias("cost_type"),
        F.lit("uncached_input_tokens").alias("token_type"),
        et.alias("model"),
        F.lit("standard").alias("service_tier"),
        F.lit("0-200k").alias("context_window"),
        F.lit("global").alias("inference_geo"),
        F.when(F.col("parity") == 0, F.lit(None).cast("string")).otherwise("w1").alias("workspace_id"),
    )
    return _bucket_frame(r, s)


# ---------------------------------------------------------------- invoices
def _cents_text(cents: F.Column) -> F.Column:
    return (cents.cast("decimal(18,0)") / 100).cast("decimal(18,2)").cast("string")


def invoice_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly per-service invoice rows plus one footer row per month."""
    o = table(spark, sf_dir, "orders")
    month = F.trunc(F.to_date("o_orderdate"), "MM")
    per = (o.groupBy(month.alias("month"), F.col("o_orderpriority").alias("sid"))
             .agg(F.sum(F.col("o_totalprice").cast(ROW_DECIMAL)).cast("decimal(18,2)").alias("list")))
    per = (per.select("month", "sid", (F.col("list") * 100).cast("bigint").alias("list_c"))
              .withColumn("neg_c", -F.expr("list_c div 10"))
              .withColumn("sp_c", -F.expr("list_c div 20"))
              .withColumn("sub_c", F.col("list_c") + F.col("neg_c") + F.col("sp_c")))
    # The month-over-month window runs on the pre-aggregated rows (months x
    # services), never on raw orders.
    prev = F.lag("sub_c").over(Window.partitionBy("sid").orderBy("month"))
    # Percent text is integral: (delta * 100) div previous, truncated toward zero.
    per = per.withColumn("prev_sub", prev).withColumn(
        "pct", F.when(F.col("prev_sub").isNull(), F.lit("New")).otherwise(
            F.expr("cast(((sub_c - prev_sub) * 100) div prev_sub as string)")))
    services = per.select(
        "month",
        F.concat(F.lit("Priority "), F.col("sid")).alias("Service description"),
        F.col("sid").alias("Service ID"),
        _cents_text(F.col("list_c")).alias("List cost ($)"),
        _cents_text(F.col("neg_c")).alias("Negotiated savings ($)"),
        _cents_text(F.col("sp_c")).alias("Savings programmes ($)"),
        F.lit("0.00").alias("Other savings ($)"),
        ((F.col("sub_c").cast("decimal(18,0)") / 100).cast("decimal(18,4)")).cast("string").alias("Unrounded subtotal ($)"),
        _cents_text(F.col("sub_c")).alias("Subtotal ($)"),
        F.col("pct").alias("Percent change in subtotal compared to previous period"),
    )
    footer = (per.groupBy("month").agg(F.sum("list_c").alias("list_c"), F.sum("neg_c").alias("neg_c"),
                                       F.sum("sp_c").alias("sp_c"), F.sum("sub_c").alias("sub_c"))
              .select("month",
                      F.lit("Subtotal").alias("Service description"),
                      F.lit("").alias("Service ID"),
                      _cents_text(F.col("list_c")).alias("List cost ($)"),
                      _cents_text(F.col("neg_c")).alias("Negotiated savings ($)"),
                      _cents_text(F.col("sp_c")).alias("Savings programmes ($)"),
                      F.lit("0.00").alias("Other savings ($)"),
                      ((F.col("sub_c").cast("decimal(18,0)") / 100).cast("decimal(18,4)")).cast("string").alias("Unrounded subtotal ($)"),
                      _cents_text(F.col("sub_c")).alias("Subtotal ($)"),
                      F.lit("").alias("Percent change in subtotal compared to previous period")))
    rows = services.unionByName(footer)
    return rows.withColumn(
        "file_name", F.concat(F.lit("invoice_"), F.date_format("month", "yyyy-MM-dd"), F.lit(".csv"))
    ).drop("month")
