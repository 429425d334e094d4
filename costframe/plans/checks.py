"""Data checks the guides describe (D1-D5, D9, D13 lives with the invoices).

Each check is an aggregate whose output is bounded by the calendar or by the
configured ids, never by the number of rows: the big side is always reduced
by a partial (map-side) aggregation before it is shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import REPORT_TZ, local_month
from ..functions.numbers import round_sum2

# Fixed value: days a table may lag behind before it counts as stale.
MAX_LAG_DAYS = 2


def freshness(df: DataFrame, name: str, as_of: dt.date, date_col: str = "usage_date",
              max_lag_days: int = MAX_LAG_DAYS) -> DataFrame:
    """First and last date, lag behind ``as_of`` and a fresh flag."""
    agg = df.agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))
    lag = F.datediff(F.lit(as_of), F.col("last_date"))
    return agg.select(F.lit(name).alias("table"), "first_date", "last_date",
                      lag.alias("lag_days"), (lag <= max_lag_days).alias("fresh"))


def freshness_from_folders(spark: SparkSession, path: str, name: str, as_of: dt.date,
                           date_col: str = "usage_date", max_lag_days: int = MAX_LAG_DAYS) -> DataFrame:
    """Freshness of a day-partitioned table from its day folder names alone
    (D1): no data file is opened.  The folder list is file-system metadata,
    bounded by the calendar.  A day folder exists only when rows were written
    for that day, so the answer equals :func:`freshness` on the table."""
    from ..sources import files

    days = [dt.date.fromisoformat(p.rsplit("=", 1)[1])
            for p in files.glob(spark, f"{path.rstrip('/')}/{date_col}=*")]
    df = spark.createDataFrame([(d,) for d in days], f"{date_col} date")
    return freshness(df, name, as_of, date_col, max_lag_days)


def coverage(df: DataFrame, name: str, date_col: str = "usage_date") -> DataFrame:
    """Days present out of the span from the first to the last date."""
    agg = df.agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"),
                 F.count_distinct(date_col).alias("days_present"))
    return agg.select(F.lit(name).alias("table"), "first_date", "last_date", "days_present",
                      (F.datediff("last_date", "first_date") + 1).alias("days_in_span"))


def coverage_by(df: DataFrame, name: str, by: str, date_col: str = "usage_date") -> DataFrame:
    """Coverage per group (e.g. per service): first and last day, days present
    and days in the group's span (D2).  One partial aggregate per (group, day)
    first, so a group holding a third of the rows adds one row per day per
    task, not its rows."""
    days = df.select(F.col(by).alias("group"), F.col(date_col).alias("day")).distinct()
    agg = days.groupBy("group").agg(F.min("day").alias("first_date"), F.max("day").alias("last_date"),
                                    F.count(F.lit(1)).alias("days_present"))
    return agg.select(F.lit(name).alias("table"), "group", "first_date", "last_date", "days_present",
                      (F.datediff("last_date", "first_date") + 1).alias("days_in_span"))


def coverage_gaps(df: DataFrame, name: str, date_col: str = "usage_date") -> DataFrame:
    """Calendar days inside the span with no row at all.

    One scan: the data is reduced to its distinct days, and each day's gap up
    to the next one is spelt out.  The window without a partition holds the
    distinct days, whose number the calendar bounds.
    """
    present = df.select(F.col(date_col).alias("day")).where(F.col("day").isNotNull()).distinct()
    following = F.lead("day").over(Window.orderBy("day"))
    return (present.withColumn("following", following).where(F.datediff("following", "day") > 1)
                   .select(F.lit(name).alias("table"),
                           F.explode(F.sequence(F.date_add("day", 1), F.date_sub("following", 1))).alias("day")))


def day_listing(spark: SparkSession, path: str, date_col: str = "usage_date") -> DataFrame:
    """The day of each data file of a day-partitioned table, from its listing alone.

    No data file is opened: Spark lists the folders (in parallel beyond a few)
    and reads the days off their names.  Freshness, coverage and gaps of this
    frame equal the table's, since a day has a file only if it has rows.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return listed.select(F.col(date_col).cast("date").alias(date_col))


def bounds_from_footers(spark: SparkSession, path: str, date_col: str) -> tuple[dt.date | None, dt.date | None]:
    """First and last date of a Parquet table that isn't partitioned by it, from its files' footer statistics.

    The V2 Parquet source pushes min and max into the scan: no column is read.
    """
    wanted = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        r = spark.read.parquet(path).agg(F.min(date_col), F.max(date_col)).first()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return r[0], r[1]


def freshness_from_footers(spark: SparkSession, path: str, name: str, as_of: dt.date, date_col: str = "usage_date",
                           max_lag_days: int = MAX_LAG_DAYS) -> DataFrame:
    """:func:`freshness` of a table that isn't partitioned by day, from footer statistics."""
    days = [(d,) for d in bounds_from_footers(spark, path, date_col)]
    return freshness(spark.createDataFrame(days, f"{date_col} date"), name, as_of, date_col, max_lag_days)


# ---------------------------------------------------------------- day bitmaps
# Added to a day's number, so that the numbers of all dates from year 1 on are positive.
_DAY_SHIFT = 800_000


def day_bitmaps(df: DataFrame, by: str, date_col: str = "usage_date") -> DataFrame:
    """(group, span, days): which days of each span of 32,768 a group has rows on, one bit a day.

    Bitmaps combine map-side at a fixed size, so no distinct over (group, day)
    is shuffled; a small table of them can be kept and merged with later loads'.
    """
    number = F.datediff(date_col, F.lit("1970-01-01")) + _DAY_SHIFT
    rows = df.where(F.col(date_col).isNotNull()).select(F.col(by).alias("group"), number.cast("long").alias("n"))
    return (rows.groupBy("group", F.bitmap_bucket_number("n").alias("span"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("days")))


def merge_bitmaps(*parts: DataFrame) -> DataFrame:
    """The days of several bitmap tables together, whether or not they share days."""
    return reduce(DataFrame.unionByName, parts).groupBy("group", "span").agg(F.bitmap_or_agg("days").alias("days"))


def days_of(bitmaps: DataFrame) -> DataFrame:
    """(group, day): the days that the bitmaps hold."""
    bit = "cast(conv(hex(substring(days, p div 8 + 1, 1)), 16, 10) AS INT)"
    here = F.expr(f"filter(sequence(0, octet_length(days) * 8 - 1), p -> getbit({bit}, p % 8) = 1)")
    number = F.col("p") + 1 + (F.col("span") - 1) * 32768 - _DAY_SHIFT
    return bitmaps.select("group", "span", F.explode(here).alias("p")).select("group", F.date_add(F.lit("1970-01-01").cast("date"), number.cast("int")).alias("day"))


def coverage_from_bitmaps(bitmaps: DataFrame, name: str) -> DataFrame:
    """:func:`coverage_by` from day bitmaps, exact."""
    present = bitmaps.groupBy("group").agg(F.sum(F.bitmap_count("days")).alias("days_present"))
    ends = days_of(bitmaps).groupBy("group").agg(F.min("day").alias("first_date"), F.max("day").alias("last_date"))
    both = present.alias("p").join(ends.alias("e"), F.col("p.group").eqNullSafe(F.col("e.group")))
    return both.select(F.lit(name).alias("table"), F.col("p.group").alias("group"), "first_date", "last_date", "days_present",
                       (F.datediff("last_date", "first_date") + 1).alias("days_in_span"))


def gaps_from_bitmaps(bitmaps: DataFrame, name: str) -> DataFrame:
    """The missing days of each group's span (D2), from its bitmaps."""
    following = F.lead("day").over(Window.partitionBy("group").orderBy("day"))
    return (days_of(bitmaps).withColumn("following", following).where(F.datediff("following", "day") > 1)
            .select(F.lit(name).alias("table"), "group", F.explode(F.sequence(F.date_add("day", 1), F.date_sub("following", 1))).alias("day")))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def scope_audit(spark: SparkSession, df: DataFrame, scope: str, configured: Sequence[str],
                columns: Sequence[str]) -> DataFrame:
    """Rows matched by each configured id in any of ``columns`` (D4, J3); a row counts once for an id.

    0 means the id matches nothing (wrong id, stray prefix).  The data side is
    filtered to the configured ids (pushed into the scan) and counted per id
    before the join with the configured list, which is a parameter of bounded
    size.
    """
    ids = list(dict.fromkeys(configured))
    any_match = reduce(lambda a, b: a | b, [F.col(c).isin(ids) for c in columns])
    hits = (df.filter(any_match)
              .select(F.explode(F.array_distinct(F.array(*[F.col(c) for c in columns]))).alias("configured_id"))
              .filter(F.col("configured_id").isin(ids))
              .groupBy("configured_id").agg(F.count(F.lit(1)).alias("rows")))
    conf = spark.createDataFrame([(i,) for i in ids], "configured_id string")
    return (conf.join(hits, "configured_id", "left")
                .select(F.lit(scope).alias("scope"), "configured_id",
                        F.coalesce(F.col("rows"), F.lit(0).cast("bigint")).alias("rows"),
                        F.col("rows").isNotNull().alias("matched")))


def scope_suggestions(spark: SparkSession, df: DataFrame, scope: str, configured: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """For each configured id that matches nothing, the export's ids that it may mean.

    An id is suggested if it is equal once prefix (up to the last slash) and case
    are removed, or lies within one edit (insertion, deletion or replacement) of
    that.  The export is read once, down to its distinct ids; two names within
    one edit share a name with at most one letter left out, so near misses
    meet in an equi-join, and the distance is then checked.
    """
    def plain(c: Column) -> Column:
        return F.lower(F.element_at(F.split(c, "/"), -1))

    def shortened(c: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1))), lambda k: F.concat(F.substring(c, F.lit(1), k - 1), F.substring(c, k + 1, F.length(c))))
        return F.array_distinct(F.concat(F.array(c), cut))

    found = df.select(F.explode(F.array_distinct(F.array(*[F.col(c) for c in columns]))).alias("suggestion")).where("suggestion IS NOT NULL").distinct()
    wanted = spark.createDataFrame([(i,) for i in dict.fromkeys(configured)], "configured_id string")
    missing = wanted.join(found, wanted.configured_id == found.suggestion, "left_anti")
    left = missing.withColumn("wanted", plain(F.col("configured_id"))).withColumn("via", F.explode(shortened(F.col("wanted"))))
    right = found.withColumn("have", plain(F.col("suggestion"))).withColumn("via", F.explode(shortened(F.col("have"))))
    pairs = left.join(right, "via").select("configured_id", "suggestion", F.levenshtein("wanted", "have").alias("distance")).where("distance <= 1").distinct()
    return pairs.select(F.lit(scope).alias("scope"), "configured_id", "suggestion", "distance")


def distinct_values(df: DataFrame, column: str, name: str) -> DataFrame:
    """How many distinct values a column holds."""
    return df.agg(F.count_distinct(column).alias("distinct_values")).select(
        F.lit(name).alias("column"), "distinct_values")


def monthly_sources(invoice: DataFrame, bill: DataFrame, tz: str = REPORT_TZ) -> DataFrame:
    """Invoice summary for months the live export lacks, live export for the
    months it has (D5, J4).

    Each source is aggregated once to one row per month; the two summaries
    are unioned with a preference rank and the preferred row per month is
    kept (``min_by``), so the large export is read in a single pass (an anti
    join would read it twice: once for its months, once for its sums)."""
    live = (bill.groupBy(local_month("usage_start_time", bill.schema["usage_start_time"].dataType, tz)
                         .alias("month"))
                .agg(round_sum2("cost_at_list").alias("list_cost"), round_sum2("cost").alias("cost"))
                .withColumn("source", F.lit("live")))
    inv = (invoice.groupBy(F.col("invoice_month").alias("month"))
                  .agg(round_sum2("list_cost").alias("list_cost"), round_sum2("subtotal").alias("cost"))
                  .withColumn("source", F.lit("invoice")))
    both = (live.withColumn("_pref", F.lit(0))
                .unionByName(inv.withColumn("_pref", F.lit(1))))
    picked = both.groupBy("month").agg(
        F.min_by(F.struct("source", "list_cost", "cost"), F.col("_pref")).alias("r"))
    return picked.select("month", "r.source", "r.list_cost", "r.cost")


def month_overlap(invoice: DataFrame, bill: DataFrame, tz: str = REPORT_TZ) -> DataFrame:
    """Invoice months the live export also covers (J4 violations of the guard)."""
    months = bill.select(local_month("usage_start_time", bill.schema["usage_start_time"].dataType, tz)
                         .alias("invoice_month")).distinct()
    return invoice.select("invoice_month").distinct().join(months, "invoice_month", "left_semi")
