"""Call/message report rows -> the typed call-record table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import date_prefix, first_present, row_hash, row_json
from ..functions.numbers import tolerant_double

# Fields tried in order for a record's id.
RECORD_ID_FIELDS = ["message_id", "call_id", "uuid", "id"]
# Fields tried in order for a record's usage date.
DATE_FIELDS = ["date_received", "date_start", "creation_date"]
# Products whose report is requested per direction.
PRODUCTS_WITH_DIRECTION = ("SMS", "VOICE-CALL")
DIRECTIONS = ("inbound", "outbound")
# Product -> dashboard category; VOICE-CALL splits by direction.
PRODUCT_CATEGORY = {"SMS": "SMS", "WEBSOCKET-CALL": "WebSocket"}
CDR_KEYS = ("usage_date", "record_id")

# Landing columns that describe the request, not the row.
LANDING_COLUMNS = ("product", "direction_requested", "request_start", "load_ordinal", "raw_json")


def category_for(product: Column, requested_direction: Column) -> Column:
    """Category from the product and the *requested* direction."""
    expr = None
    for prod, cat in PRODUCT_CATEGORY.items():
        expr = (F.when(product == prod, cat) if expr is None
                else expr.when(product == prod, cat))
    expr = expr.when((product == "VOICE-CALL") & (F.coalesce(requested_direction, F.lit("")) == "inbound"),
                     "Inbound Calls")
    expr = expr.when(product == "VOICE-CALL", "Outbound Calls")
    return expr.otherwise("Other")


def _present(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def normalise_cdr(raw: DataFrame, raw_columns: list[str] | None = None) -> DataFrame:
    """Typed call records from raw report rows.

    ``raw`` carries the raw text columns plus the landing columns ``product``,
    ``direction_requested`` and ``request_start``.  Absent columns are NULL;
    present-but-empty text stays '' for currency/network/country/status.
    """
    row_cols = raw_columns or [c for c in raw.columns if c not in LANDING_COLUMNS]
    ids = _present(raw, RECORD_ID_FIELDS)
    dates = _present(raw, DATE_FIELDS)
    rid = first_present(ids) if ids else F.lit(None).cast("string")
    # Without an id the whole row is one: as landed, columns that the scan doesn't type included.
    whole = F.sha2("raw_json", 256) if "raw_json" in raw.columns else row_hash(row_cols)
    record_id = F.coalesce(rid, whole)
    day_text = F.coalesce(first_present(dates), F.col("request_start")) if dates else F.col("request_start")
    requested = F.col("direction_requested")
    row_dir = F.col("direction") if "direction" in raw.columns else F.lit(None).cast("string")

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in raw.columns else F.lit(None).cast("string")

    price = tolerant_double(F.col("total_price")) if "total_price" in raw.columns else F.lit(None).cast("double")
    out = [
        date_prefix(day_text).alias("usage_date"),
        record_id.alias("record_id"),
        F.col("product"),
        F.coalesce(F.nullif(row_dir, F.lit("")), requested).alias("direction"),
        category_for(F.col("product"), requested).alias("category"),
        price.alias("total_price"),
        text("currency").alias("currency"),
        text("network").alias("network"),
        text("country").alias("country"),
        text("status").alias("status"),
        (F.col("raw_json") if "raw_json" in raw.columns else row_json(row_cols)).alias("raw"),
    ]
    if "load_ordinal" in raw.columns:
        out.append(F.col("load_ordinal"))
    return raw.select(*out)


def request_pairs(products: list[str]) -> list[tuple[str, str | None]]:
    """(product, direction) pairs pulled per run: both directions only where the
    product takes one, otherwise a single request without direction (S8)."""
    pairs: list[tuple[str, str | None]] = []
    for p in products:
        if p in PRODUCTS_WITH_DIRECTION:
            pairs.extend((p, d) for d in DIRECTIONS)
        else:
            pairs.append((p, None))
    return pairs


def promote_raw_field(df: DataFrame, field: str, alias: str | None = None,
                      cast: str | None = None) -> DataFrame:
    """Promote one field out of the JSON ``raw`` column."""
    v = F.get_json_object(F.col("raw"), f"$.{field}")
    if cast:
        v = v.try_cast(cast)
    return df.withColumn(alias or field, v)


def variant_raw(df: DataFrame, raw: str = "raw") -> DataFrame:
    """``df`` with its JSON text as VARIANT, the type that a document column has in the target.

    Text that is not JSON becomes NULL: rows of a report always are.
    """
    return df.withColumn(raw, F.try_parse_json(F.col(raw)))


def promote_variant_field(df: DataFrame, field: str, alias: str | None = None, cast: str = "string", raw: str = "raw") -> DataFrame:
    """Promote one field out of a VARIANT ``raw`` column (D10): binary paths, no text is parsed; a value that doesn't cast is NULL."""
    return df.withColumn(alias or field, F.try_variant_get(F.col(raw), f"$.{field}", cast))
