"""The registered queries: one Spark plan and one DuckDB oracle per name.

Every query reads the driver's tables (through the fixture views) in full;
month windows, scopes and top-10 limits are the report features themselves.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import fixtures as fx
from . import oracle as orc
from .plans import reports as rp
from .session import prepare

# Parameters of the registered queries (the fixture's report dates and scopes).
AS_OF_SUMMER = dt.date(1998, 8, 19)
AS_OF_WINTER = dt.date(1998, 1, 10)
CDR_AS_OF = dt.date(2024, 1, 19)
PLATFORM_PROJECTS = ["3", "7", "12", "21", "1030", "1044", "1058", "1071"]
PLATFORM_SERVICES = ["Brand#11", "Brand#12", "Brand#13", "Brand#14", "Brand#15", "Brand#21",
                     "Brand#22", "Brand#23", "Brand#31", "Brand#32", "Brand#41", "Brand#99"]
API_PROJECTS = ["16", "1011"]
API_SERVICES = ["Brand#5", "Brand#2"]
FEE_SKUS = ["PROMO"]

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if oracle is not None:
            _ORACLES[name] = oracle
        return run
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


# ------------------------------------------------------------ billing export
@register("bill_all_services", orc.breakdown_sql(AS_OF_SUMMER))
def bill_all_services(spark, sf_dir):
    """Q1: all services, current London month, top 10 by subtotal."""
    return rp.cost_breakdown(fx.bill(spark, sf_dir), AS_OF_SUMMER)


@register("bill_all_services_winter", orc.breakdown_sql(AS_OF_WINTER))
def bill_all_services_winter(spark, sf_dir):
    """Q1 in a winter month (London midnight = UTC midnight)."""
    return rp.cost_breakdown(fx.bill(spark, sf_dir), AS_OF_WINTER)


@register("bill_scoped_top10", orc.breakdown_sql(AS_OF_SUMMER, projects=PLATFORM_PROJECTS,
                                                 services=PLATFORM_SERVICES))
def bill_scoped_top10(spark, sf_dir):
    """Q2: projects (id or number) x services scope, top 10."""
    return rp.cost_breakdown(fx.bill(spark, sf_dir), AS_OF_SUMMER,
                             projects=PLATFORM_PROJECTS, services=PLATFORM_SERVICES)


@register("bill_scoped_all", orc.breakdown_sql(AS_OF_SUMMER, projects=API_PROJECTS,
                                               services=API_SERVICES, limit=None))
def bill_scoped_all(spark, sf_dir):
    """Q3: two projects, two services, no limit."""
    return rp.cost_breakdown(fx.bill(spark, sf_dir), AS_OF_SUMMER,
                             projects=API_PROJECTS, services=API_SERVICES, limit=None)


@register("bill_scoped_arrears", orc.breakdown_sql(AS_OF_SUMMER, offset=-1, projects=PLATFORM_PROJECTS,
                                                   services=PLATFORM_SERVICES))
def bill_scoped_arrears(spark, sf_dir):
    """Q7: the scoped report a month in arrears."""
    return rp.cost_breakdown(fx.bill(spark, sf_dir), AS_OF_SUMMER, month_offset=-1,
                             projects=PLATFORM_PROJECTS, services=PLATFORM_SERVICES)


@register("bill_cud_fee", orc.breakdown_sql(AS_OF_SUMMER, fee_skus=FEE_SKUS))
def bill_cud_fee(spark, sf_dir):
    """Commitment-fee SKUs moved from Cost to Savings programmes."""
    return rp.cost_breakdown(fx.bill(spark, sf_dir), AS_OF_SUMMER, fee_skus=FEE_SKUS)


def _restated_day_sums(spark, sf_dir, fee_skus=None):
    """Day sums of an export whose August was wrong, after August's days were restated."""
    from pyspark.sql import functions as F

    from .plans.daysums import DAY, refresh_day_sums
    from .session import scratch_path

    path = scratch_path(spark, "bill-day-sums")
    bill = fx.bill(spark, sf_dir)
    day = F.to_date(F.col("usage_start_time").cast("timestamp"))
    late = (day >= F.lit(SUMS_RESTATED[0])) & (day <= F.lit(SUMS_RESTATED[-1]))
    wrong = bill.withColumn("cost", F.when(late, F.col("cost") * 2).otherwise(F.col("cost")))
    # One day held nothing but rows that are gone since.
    stale = wrong.withColumn("usage_start_time", F.when(day == F.lit(SUMS_RESTATED[3]), F.col("usage_start_time") + F.expr("INTERVAL 20000 DAYS"))
                             .otherwise(F.col("usage_start_time")))
    refresh_day_sums(spark, stale, path, fee_skus=fee_skus)
    vanished = [d + dt.timedelta(days=20000) for d in (SUMS_RESTATED[3],)]
    refresh_day_sums(spark, bill, path, [*SUMS_RESTATED, *vanished], fee_skus=fee_skus)
    return spark.read.parquet(path)


SUMS_RESTATED = [dt.date(1998, 7, 31) + dt.timedelta(days=k) for k in range(33)]


@register("bill_from_day_sums", orc.breakdown_sql(AS_OF_SUMMER))
def bill_from_day_sums(spark, sf_dir):
    """Q1 from day sums kept current over a restatement; the export is not read for the report."""
    from .plans.daysums import cost_from_day_sums

    return cost_from_day_sums(_restated_day_sums(spark, sf_dir), AS_OF_SUMMER)


@register("bill_scoped_from_day_sums", orc.breakdown_sql(AS_OF_SUMMER, projects=PLATFORM_PROJECTS, services=PLATFORM_SERVICES, fee_skus=FEE_SKUS))
def bill_scoped_from_day_sums(spark, sf_dir):
    """Q2 and D12 from the same kind of sums: scopes by project id or number, fee SKUs fixed in the sums."""
    from .plans.daysums import cost_from_day_sums

    return cost_from_day_sums(_restated_day_sums(spark, sf_dir, FEE_SKUS), AS_OF_SUMMER, projects=PLATFORM_PROJECTS, services=PLATFORM_SERVICES)


@register("credit_sums", orc.credit_rows_sql())
def credit_sums(spark, sf_dir):
    """Per-row CUD and other credit sums (HOFs over the row's array)."""
    return rp.credit_columns(fx.bill(spark, sf_dir))


@register("credit_sums_lateral", orc.credit_rows_sql())
def credit_sums_lateral(spark, sf_dir):
    """J2 cross-check: the same sums as a correlated LATERAL over explode_outer."""
    return rp.credit_columns_lateral(spark, fx.bill(spark, sf_dir))


# ------------------------------------------------------------ cost and usage
@register("cur_services", orc.cur_by_service_sql(AS_OF_SUMMER))
def cur_services(spark, sf_dir):
    """Q4: unblended cost by product, current month, top 10."""
    return rp.cur_cost_by_service(fx.cur(spark, sf_dir), AS_OF_SUMMER)


@register("cur_monthly", orc.cur_by_service_sql(AS_OF_WINTER, offset=-1, label="Service"))
def cur_monthly(spark, sf_dir):
    """Q5: previous month (December across the year boundary), label 'Service'."""
    return rp.cur_cost_by_service(fx.cur(spark, sf_dir), AS_OF_WINTER, month_offset=-1, label="Service")


@register("cur_effective_costs", orc.cur_by_service_sql(AS_OF_SUMMER, effective=True))
def cur_effective_costs(spark, sf_dir):
    """Reservation and savings-plan effective cost next to unblended cost."""
    return rp.cur_cost_by_service(fx.cur(spark, sf_dir), AS_OF_SUMMER, effective=True)


@register("cur_by_environment", orc.cur_by_environment_sql(AS_OF_SUMMER))
def cur_by_environment(spark, sf_dir):
    """Cost and line-item count per environment tag."""
    return rp.cur_cost_by_environment(fx.cur(spark, sf_dir), AS_OF_SUMMER)


# ------------------------------------------------------------ call records
@register("cdr_services", orc.cdr_by_category_sql(CDR_AS_OF))
def cdr_services(spark, sf_dir):
    """Q6: EUR cost by category, current month, no limit."""
    return rp.cdr_cost_by_category(fx.cdr(spark, sf_dir), CDR_AS_OF)


@register("sources_side_by_side", orc.side_by_side_sql(AS_OF_SUMMER, AS_OF_SUMMER, CDR_AS_OF))
def sources_side_by_side(spark, sf_dir):
    """The three sources side by side, one currency per row, never summed across."""
    return rp.sources_side_by_side(fx.bill(spark, sf_dir), fx.cur(spark, sf_dir), fx.cdr(spark, sf_dir),
                                   bill_as_of=AS_OF_SUMMER, cur_as_of=AS_OF_SUMMER, cdr_as_of=CDR_AS_OF)


# ------------------------------------------------------------ normalisers
def ntz(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns as their UTC wall clock (TIMESTAMP_NTZ), for comparison
    with engines that have no instant type in the result."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


@register("cur_normalise", orc.CUR_TABLE_SQL)
def cur_normalise(spark, sf_dir):
    """Raw report text -> the 25 typed columns (round trip of the cur view)."""
    from .operators.cur import normalise_cur
    from .operators.tables import conform
    from .schemas import CUR_SCHEMA, required

    return ntz(conform(normalise_cur(fx.cur_raw(spark, sf_dir)), CUR_SCHEMA, required(CUR_SCHEMA)))


@register("cdr_normalise", orc.CDR_TABLE_SQL)
def cdr_normalise(spark, sf_dir):
    """Raw call/message rows -> typed records."""
    from .operators.cdr import normalise_cdr
    from .operators.tables import conform
    from .schemas import CDR_SCHEMA, required

    return conform(normalise_cdr(fx.cdr_raw(spark, sf_dir)), CDR_SCHEMA, required(CDR_SCHEMA)).drop("raw")


@register("cdr_promote_raw", orc.CDR_PROMOTED_SQL)
def cdr_promote_raw(spark, sf_dir):
    """The whole raw row kept as JSON, fields promoted back out of it."""
    from pyspark.sql import functions as F

    from .operators.cdr import normalise_cdr, promote_raw_field

    t = normalise_cdr(fx.cdr_raw(spark, sf_dir))
    t = promote_raw_field(t, "status", "raw_status")
    t = promote_raw_field(t, "client_ref", "client_ref")
    return t.select("record_id", "raw_status",
                    F.get_json_object("client_ref", "$.k").try_cast("bigint").alias("client_k"))


@register("cdr_promote_variant", orc.CDR_PROMOTED_SQL)
def cdr_promote_variant(spark, sf_dir):
    """Raw rows written and read as VARIANT, fields promoted by path."""
    from pyspark.sql import functions as F

    from .operators.cdr import normalise_cdr, promote_variant_field, variant_raw
    from .session import scratch_path

    path = scratch_path(spark, "cdr-variant")
    variant_raw(normalise_cdr(fx.cdr_raw(spark, sf_dir))).write.parquet(path)
    t = promote_variant_field(spark.read.parquet(path), "status", "raw_status")
    ref = F.try_parse_json(F.try_variant_get("raw", "$.client_ref", "string"))
    return t.select("record_id", "raw_status", F.try_variant_get(ref, "$.k", "bigint").alias("client_k"))


@register("usage_flatten", orc.USAGE_FLAT_SQL)
def usage_flatten(spark, sf_dir):
    """Usage buckets -> 18-column keyed rows."""
    from .operators.usage import flatten_usage

    return ntz(flatten_usage(fx.usage_buckets(spark, sf_dir)))


@register("cost_flatten", orc.COST_FLAT_SQL)
def cost_flatten(spark, sf_dir):
    """Cost buckets -> 14-column keyed rows, strict amount parse."""
    from .operators.usage import flatten_cost

    return ntz(flatten_cost(fx.cost_buckets(spark, sf_dir)))


@register("usage_total_input", orc.USAGE_TOTAL_INPUT_SQL)
def usage_total_input(spark, sf_dir):
    """Total input tokens = uncached + cache read + both cache creations."""
    from .operators.usage import flatten_usage

    return rp.usage_input_by_day(flatten_usage(fx.usage_buckets(spark, sf_dir)))


@register("usage_rollup", orc.USAGE_ROLLUP_SQL)
def usage_rollup(spark, sf_dir):
    """Events rolled into 1h buckets per event type."""
    from pyspark.sql import functions as F

    from .functions.numbers import round_sum2

    ev = fx.table(spark, sf_dir, "events")
    return ntz(rp.rollup(ev, "ts", "1h", ["event_type"], {
        "events": F.count(F.lit(1)),
        "output_tokens": F.sum(F.floor("value").cast("bigint")),
        "value": round_sum2("value"),
    }))


@register("usage_rollup_minutes", orc.USAGE_ROLLUP_MINUTES_SQL)
def usage_rollup_minutes(spark, sf_dir):
    """Events rolled into 1m buckets per event type."""
    from pyspark.sql import functions as F

    ev = fx.table(spark, sf_dir, "events")
    return ntz(rp.rollup(ev, "ts", "1m", ["event_type"], {
        "events": F.count(F.lit(1)),
        "output_tokens": F.sum(F.floor("value").cast("bigint")),
    }))


@register("invoice_normalise", orc.INVOICE_TABLE_SQL)
def invoice_normalise(spark, sf_dir):
    """Invoice rows typed, month from the file name, footers dropped."""
    from .operators.invoice import normalise_invoice

    return normalise_invoice(fx.invoice_raw(spark, sf_dir))


@register("invoice_reconcile", orc.INVOICE_RECONCILE_SQL)
def invoice_reconcile(spark, sf_dir):
    """Per-service subtotals against the footer total, per month."""
    from .operators.invoice import reconcile_invoice

    return reconcile_invoice(fx.invoice_raw(spark, sf_dir))


@register("billing_periods", orc.BILLING_PERIODS_SQL)
def billing_periods(spark, sf_dir):
    """Billing-period labels to re-read for every order date."""
    from pyspark.sql import functions as F

    from .functions.dates import periods_to_check

    days = fx.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("as_of")).distinct()
    return days.select("as_of", F.posexplode(periods_to_check("as_of"))).select(
        "as_of", F.col("col").alias("period"), (F.col("pos") > 0).alias("is_previous"))


@register("lookback_window", orc.lookback_sql(CDR_AS_OF, 2))
def lookback_window(spark, sf_dir):
    """The [as_of - 2 days, as_of) re-read window of the call records."""
    from .functions.dates import lookback

    c = fx.cdr(spark, sf_dir)
    return c.filter(lookback("usage_date", CDR_AS_OF, 2)).select(
        "record_id", "usage_date", "product", "total_price")


# ------------------------------------------------------------ upsert
CDR_KEYS = ["usage_date", "record_id"]
LIVE_FROM = dt.date(1998, 1, 1)


def _bump(df: DataFrame, by: float) -> DataFrame:
    from pyspark.sql import functions as F

    return df.withColumn("total_price", F.col("total_price") + F.lit(by))


def _products(df: DataFrame, *names: str) -> DataFrame:
    from pyspark.sql import functions as F

    return df.filter(F.col("product").isin(list(names)))


def _upsert_parts(spark, sf_dir):
    """Target: every record but VOICE-TTS.  Source: SMS (updates existing
    keys) and VOICE-TTS (new keys), each price + 1."""
    from pyspark.sql import functions as F

    c = fx.cdr(spark, sf_dir)
    return c.filter(F.col("product") != "VOICE-TTS"), _bump(_products(c, "SMS", "VOICE-TTS"), 1.0)


@register("upsert_cdr", orc.UPSERT_SQL)
def upsert_cdr(spark, sf_dir):
    """Keyed MERGE as anti join + union; target-only keys stay."""
    from .operators.tables import collapse_loads, merge

    target, source = _upsert_parts(spark, sf_dir)
    return merge(target, collapse_loads(source, CDR_KEYS), CDR_KEYS)


@register("upsert_last_wins", orc.LAST_WINS_SQL)
def upsert_last_wins(spark, sf_dir):
    """§1.4.11: two loads in one pass; VOICE-CALL is in both, the later load wins."""
    from pyspark.sql import functions as F

    from .operators.tables import collapse_loads, merge

    c = fx.cdr(spark, sf_dir)
    loads = (_bump(_products(c, "SMS", "VOICE-CALL"), 1.0).withColumn("load_ordinal", F.lit(1))
             .unionByName(_bump(_products(c, "VOICE-CALL", "WEBSOCKET-CALL"), 2.0)
                          .withColumn("load_ordinal", F.lit(2))))
    target = c.filter(F.col("product") != "WEBSOCKET-CALL")
    return merge(target, collapse_loads(loads, CDR_KEYS, "load_ordinal"), CDR_KEYS)


RESTATED_DAYS = (dt.date(2024, 1, 14), dt.date(2024, 1, 17))


@register("replace_days", orc.REPLACE_DAYS_SQL)
def replace_days(spark, sf_dir):
    """K6: a restated window of days replaces those days whole (here by SMS rows only)."""
    from pyspark.sql import functions as F

    from .operators.tables import replace_days as replace

    c = fx.cdr(spark, sf_dir)
    lo, hi = RESTATED_DAYS
    source = _bump(_products(c, "SMS").filter((F.col("usage_date") >= F.lit(lo)) & (F.col("usage_date") < F.lit(hi))),
                   1.0)
    return replace(c, source, "usage_date")


@register("upsert_twice_counts", orc.UPSERT_TWICE_SQL)
def upsert_twice_counts(spark, sf_dir):
    """D3, K4, K5, K7: load the same source once and twice into written
    day-partitioned tables; the table is the same after both."""
    from pyspark.sql import functions as F

    from .functions.numbers import round_sum2
    from .operators.tables import upsert_table, write_table
    from .session import scratch_path

    target, source = _upsert_parts(spark, sf_dir)
    out = []
    for run in (1, 2):
        path = scratch_path(spark, f"cdr-upsert-run{run}")
        write_table(target, path)
        for _ in range(run):
            upsert_table(spark, path, source, CDR_KEYS)
        upsert_table(spark, path, source.limit(0), CDR_KEYS)  # empty load: no-op
        out.append(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"),
                                                round_sum2("total_price").alias("total_price"))
                   .select(F.lit(run).alias("run"), "rows", "total_price"))
    return out[0].unionByName(out[1])


@register("upsert_bucketed", orc.UPSERT_SQL)
def upsert_bucketed(spark, sf_dir):
    """The keyed MERGE into a bucketed catalog table; only the load is shuffled."""
    from .operators.bucketed import create_bucketed
    from .operators.bucketed import upsert_bucketed as upsert
    from .session import scratch_path

    target, source = _upsert_parts(spark, sf_dir)
    path = scratch_path(spark, "cdr-bucketed")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    create_bucketed(target, name, CDR_KEYS, 4, path)
    upsert(spark, name, source, CDR_KEYS)
    upsert(spark, name, source.limit(0), CDR_KEYS)  # empty load: no-op
    out = spark.read.schema(spark.table(name).schema).parquet(path).select(*target.columns)
    spark.sql(f"DROP TABLE {name}")  # external: its files stay
    return out


@register("load_summary", orc.LOAD_SUMMARY_SQL)
def load_summary(spark, sf_dir):
    """K8: rows staged per (product, requested direction) load and their days."""
    from .functions.keys import date_prefix
    from .operators.tables import load_summary as summary

    raw = fx.cdr_raw(spark, sf_dir).withColumn("usage_date", date_prefix("request_start"))
    return summary(raw, ["product", "direction_requested"])


# ------------------------------------------------------------ checks
@register("duplicate_keys", orc.DUPLICATE_KEYS_SQL)
def duplicate_keys(spark, sf_dir):
    """Keys claimed unique that are not ((orderkey, linenumber) of lineitem)."""
    from .plans.checks import duplicate_keys as dup

    return dup(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("duplicate_suspects", orc.DUPLICATE_SUSPECTS_SQL)
def duplicate_suspects(spark, sf_dir):
    """D9 by suspects: (partkey, shipdate) of lineitem, a key that is nearly unique."""
    from .plans.duplicates import duplicate_keys_by_suspects

    return duplicate_keys_by_suspects(fx.table(spark, sf_dir, "lineitem"), ["l_partkey", "l_shipdate"])


@register("cur_duplicate_suspects", orc.CUR_DUPLICATES_SQL)
def cur_duplicate_suspects(spark, sf_dir):
    """D9 by suspects over the cost-and-usage table's own key (K3), its latest days appended twice."""
    from .plans.duplicates import duplicate_keys_by_suspects

    df = fx.cur(spark, sf_dir).select("usage_date", "line_item_id")
    return duplicate_keys_by_suspects(df.unionAll(df.where(df.usage_date >= orc.APPENDED_FROM)), ["usage_date", "line_item_id"])


FRESH_CDR_AS_OF = dt.date(2024, 2, 1)
FRESH_CUR_AS_OF = dt.date(2001, 11, 10)


@register("freshness", orc.freshness_sql(FRESH_CDR_AS_OF, FRESH_CUR_AS_OF))
def freshness(spark, sf_dir):
    """Last date per table and whether it is within two days."""
    from .plans.checks import freshness as fresh

    return fresh(fx.cdr(spark, sf_dir), "cdr", FRESH_CDR_AS_OF).unionByName(
        fresh(fx.cur(spark, sf_dir), "cur", FRESH_CUR_AS_OF))


@register("coverage", orc.COVERAGE_SQL)
def coverage(spark, sf_dir):
    """Days present out of the covered span."""
    from .plans.checks import coverage as cov

    return cov(fx.cdr(spark, sf_dir), "cdr").unionByName(cov(fx.cur(spark, sf_dir), "cur"))


@register("coverage_gaps", orc.COVERAGE_GAPS_SQL)
def coverage_gaps(spark, sf_dir):
    """The missing days themselves."""
    from .plans.checks import coverage_gaps as gaps

    return gaps(fx.cdr(spark, sf_dir), "cdr").unionByName(gaps(fx.cur(spark, sf_dir), "cur"))


@register("freshness_from_metadata", orc.freshness_sql(FRESH_CDR_AS_OF, FRESH_CUR_AS_OF))
def freshness_from_metadata(spark, sf_dir):
    """D1, A6 without reading a column: a day-partitioned table's listing, a flat table's footers."""
    from .operators.tables import write_table
    from .plans.checks import day_listing, freshness_from_footers
    from .plans.checks import freshness as fresh
    from .session import scratch_path

    days, flat = scratch_path(spark, "cdr-by-day"), scratch_path(spark, "cur-flat")
    write_table(fx.cdr(spark, sf_dir), days)
    fx.cur(spark, sf_dir).write.parquet(flat)
    return fresh(day_listing(spark, days), "cdr", FRESH_CDR_AS_OF).unionByName(
        freshness_from_footers(spark, flat, "cur", FRESH_CUR_AS_OF))


def _by_day(spark, sf_dir):
    """(name, listing) of the two tables, written by day."""
    from .operators.tables import write_table
    from .plans.checks import day_listing
    from .session import scratch_path

    for name, df in (("cdr", fx.cdr(spark, sf_dir)), ("cur", fx.cur(spark, sf_dir))):
        path = scratch_path(spark, f"{name}-by-day")
        write_table(df, path)
        yield name, day_listing(spark, path)


@register("coverage_from_metadata", orc.COVERAGE_SQL)
def coverage_from_metadata(spark, sf_dir):
    """D2 from the listing of day-partitioned tables; no file is opened."""
    from .plans.checks import coverage as cov

    a, b = (cov(days, name) for name, days in _by_day(spark, sf_dir))
    return a.unionByName(b)


@register("coverage_gaps_from_metadata", orc.COVERAGE_GAPS_SQL)
def coverage_gaps_from_metadata(spark, sf_dir):
    """The missing days, from the listing of day-partitioned tables."""
    from .plans.checks import coverage_gaps as gaps

    a, b = (gaps(days, name) for name, days in _by_day(spark, sf_dir))
    return a.unionByName(b)


AUDIT_PROJECTS = ["3", "1007", "projects/12", "250", "1099"]
AUDIT_SERVICES = ["Brand#11", "services/Brand#12", "Brand#99"]


@register("scope_audit", orc.scope_audit_sql(AUDIT_PROJECTS, AUDIT_SERVICES))
def scope_audit(spark, sf_dir):
    """Configured scope ids that match nothing in the export (0 rows)."""
    from .plans.checks import scope_audit as audit

    b = fx.bill(spark, sf_dir)
    return audit(spark, b, "project", AUDIT_PROJECTS, ["project.id", "project.number"]).unionByName(
        audit(spark, b, "service", AUDIT_SERVICES, ["service.id"]))


SUGGEST_PROJECTS = [*AUDIT_PROJECTS, "PROJECTS/250", "10071", "nothing-like-it"]
SUGGEST_SERVICES = [*AUDIT_SERVICES, "brand#12", "services/BRAND#3", "Brnd#44"]


@register("scope_suggestions", orc.scope_suggestions_sql(SUGGEST_PROJECTS, SUGGEST_SERVICES))
def scope_suggestions(spark, sf_dir):
    """What ids without a match may mean: another case or prefix, or one edit away."""
    from .plans.checks import scope_suggestions as suggest

    b = fx.bill(spark, sf_dir)
    return suggest(spark, b, "project", SUGGEST_PROJECTS, ["project.id", "project.number"]).unionByName(
        suggest(spark, b, "service", SUGGEST_SERVICES, ["service.id"]))


@register("month_source_union", orc.month_sources_sql(LIVE_FROM))
def month_source_union(spark, sf_dir):
    """Invoice summary before the live export starts, live export after."""
    from pyspark.sql import functions as F

    from .functions.dates import local_midnight_utc
    from .operators.invoice import normalise_invoice
    from .plans.checks import monthly_sources

    b = fx.bill(spark, sf_dir)
    start = local_midnight_utc(LIVE_FROM).strftime("%Y-%m-%d %H:%M:%S")
    live = b.filter(F.col("usage_start_time") >= F.expr(f"TIMESTAMP_NTZ '{start}'"))
    return monthly_sources(normalise_invoice(fx.invoice_raw(spark, sf_dir)), live)


# ------------------------------------------------------------ landed files
@register("cur_csv_roundtrip", orc.CUR_TABLE_SQL)
def cur_csv_roundtrip(spark, sf_dir):
    """Land the report as gzip CSV parts + manifests per
    period, scan every period through its manifest, normalise."""
    from .landing import land_cur
    from .operators.cur import normalise_cur
    from .session import scratch_path
    from .sources.cur import cur_scan

    bucket = scratch_path(spark, "cur-landing")
    land_cur(spark, fx.cur_raw(spark, sf_dir), bucket, "costs")
    return ntz(normalise_cur(cur_scan(spark, bucket, "costs")))


@register("cur_load_by_name", orc.CUR_TABLE_SQL)
def cur_load_by_name(spark, sf_dir):
    """Every landed period and one without a manifest through the load job, a late period
    in the daily job again, both by (usage_date, line_item_id); the table is read back by its name."""
    from .functions.dates import period_labels_to_check
    from .landing import land_cur
    from .plans.loads import load_cur
    from .schemas import CUR_SCHEMA
    from .session import scratch_path
    from .sources.tables import table_scan

    bucket, path = scratch_path(spark, "cur-load-landing"), scratch_path(spark, "cur-loaded")
    periods = land_cur(spark, fx.cur_raw(spark, sf_dir), bucket, "costs")
    load_cur(spark, bucket, "costs", path, periods=[*period_labels_to_check(dt.date(1901, 1, 20)), *periods])
    load_cur(spark, bucket, "costs", path, as_of=dt.date(1998, 8, 5))
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return ntz(table_scan(spark, name).select(*CUR_SCHEMA.names))


@register("cdr_zip_roundtrip", orc.CDR_TABLE_SQL)
def cdr_zip_roundtrip(spark, sf_dir):
    """Land one zipped CSV report per (product, direction, day), scan
    the zips (binaryFile + unzip), normalise."""
    from .landing import land_cdr
    from .operators.cdr import normalise_cdr
    from .session import scratch_path
    from .sources.cdr import zip_csv_scan

    root = scratch_path(spark, "cdr-landing")
    land_cdr(spark, fx.cdr_raw(spark, sf_dir), root)
    return normalise_cdr(zip_csv_scan(spark, root)).drop("raw")


@register("cdr_zip_source", orc.CDR_TABLE_SQL)
def cdr_zip_source(spark, sf_dir):
    """The same landed zips through the Python data source, an archive a partition."""
    from .landing import land_cdr
    from .operators.cdr import normalise_cdr
    from .session import scratch_path
    from .sources.zip_reports import zip_report_scan

    root = scratch_path(spark, "cdr-source-landing")
    land_cdr(spark, fx.cdr_raw(spark, sf_dir), root)
    return normalise_cdr(zip_report_scan(spark, root)).drop("raw")


@register("bucket_json_roundtrip", orc.USAGE_FLAT_SQL)
def bucket_json_roundtrip(spark, sf_dir):
    """Land usage buckets as JSON pages, scan all pages, flatten."""
    from .landing import land_pages
    from .operators.usage import flatten_usage
    from .session import scratch_path
    from .sources.buckets import USAGE_RESULT, bucket_scan

    root = scratch_path(spark, "usage-pages")
    land_pages(spark, fx.usage_buckets(spark, sf_dir), root)
    return ntz(flatten_usage(bucket_scan(spark, root, USAGE_RESULT, multi_line=False)))


@register("invoice_csv_roundtrip", orc.INVOICE_TABLE_SQL)
def invoice_csv_roundtrip(spark, sf_dir):
    """Land one dated CSV per invoice month, scan the folder, normalise."""
    from .landing import land_invoices
    from .operators.invoice import normalise_invoice
    from .session import scratch_path
    from .sources.invoices import invoice_scan

    root = scratch_path(spark, "invoices")
    land_invoices(spark, fx.invoice_raw(spark, sf_dir), root)
    return normalise_invoice(invoice_scan(spark, root))


def _overlapping_pulls(spark, buckets, result, flatten, schema, kind):
    """Three landed pulls with shared days, loaded twice by the job; the table."""
    from pyspark.sql import functions as F

    from .landing import land_pages
    from .plans.loads import load_buckets
    from .session import scratch_path

    root, table = scratch_path(spark, f"{kind}-pulls"), scratch_path(spark, f"{kind}-pulled")
    day = F.dayofmonth(F.substring("starting_at", 1, 10).cast("date"))
    for n, part in enumerate([buckets.filter(day <= 15), buckets.filter((day >= 10) & (day <= 20)), buckets.filter(day >= 18)]):
        land_pages(spark, part, f"{root}/pull={n}")
    for _ in range(2):
        load_buckets(spark, root, table, result, flatten, schema, multi_line=False)
    return ntz(spark.read.parquet(table).select(*flatten(buckets.limit(0)).columns))


@register("usage_overlapping_pulls", orc.USAGE_FLAT_SQL)
def usage_overlapping_pulls(spark, sf_dir):
    """Overlapping pulls of usage pages through the load job, twice."""
    from .operators.usage import flatten_usage
    from .schemas import USAGE_SCHEMA
    from .sources.buckets import USAGE_RESULT

    return _overlapping_pulls(spark, fx.usage_buckets(spark, sf_dir), USAGE_RESULT, flatten_usage, USAGE_SCHEMA, "usage")


@register("cost_overlapping_pulls", orc.COST_FLAT_SQL)
def cost_overlapping_pulls(spark, sf_dir):
    """Overlapping pulls of cost pages through the load job, twice."""
    from .operators.usage import flatten_cost
    from .schemas import COST_SCHEMA
    from .sources.buckets import COST_RESULT

    return _overlapping_pulls(spark, fx.cost_buckets(spark, sf_dir), COST_RESULT, flatten_cost, COST_SCHEMA, "cost")


@register("cdr_overlapping_windows", orc.CDR_TABLE_SQL)
def cdr_overlapping_windows(spark, sf_dir):
    """Each SMS record also in the request window of the day before,
    with another price; the load job runs twice and the later window wins."""
    from pyspark.sql import functions as F

    from .landing import land_cdr
    from .plans.loads import load_cdr
    from .session import scratch_path

    root, table = scratch_path(spark, "cdr-windows"), scratch_path(spark, "cdr-windowed")
    raw = fx.cdr_raw(spark, sf_dir)
    before = F.date_format(F.date_sub(F.to_date(F.substring("request_start", 1, 10)), 1), "yyyy-MM-dd'T'00:00:00'Z'")
    early = _products(raw, "SMS").withColumns({"request_start": before, "total_price": F.lit("0.5")})
    land_cdr(spark, raw.unionByName(early), root)
    last = fx.cdr(spark, sf_dir).agg(F.max("usage_date")).first()[0]
    for _ in range(2):
        load_cdr(spark, root, table, as_of=last + dt.timedelta(days=1), lookback_days=36500)
    return spark.read.parquet(table).select(*fx.cdr(spark, sf_dir).drop("raw").columns)


@register("cdr_fallback_ids", orc.CDR_FALLBACK_SQL)
def cdr_fallback_ids(spark, sf_dir):
    """Reports without an id column whose rows differ only in a column that
    the scan doesn't type; every row keeps an id of its own."""
    from pyspark.sql import functions as F

    from .landing import land_cdr
    from .operators.cdr import RECORD_ID_FIELDS, normalise_cdr
    from .session import scratch_path
    from .sources.cdr import zip_csv_scan

    root = scratch_path(spark, "cdr-without-ids")
    raw = fx.cdr_raw(spark, sf_dir)
    ref = F.concat_ws("", *RECORD_ID_FIELDS)
    land_cdr(spark, raw.select("product", "direction_requested", "request_start", "country", ref.alias("vendor_ref")), root)
    rows = normalise_cdr(zip_csv_scan(spark, root))
    return rows.groupBy("product").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("record_id").alias("ids"))


@register("invoice_mixed_headers", orc.INVOICE_MIXED_SQL)
def invoice_mixed_headers(spark, sf_dir):
    """Months with another order of columns and one column less, through the load job, twice."""
    from pyspark.sql import functions as F

    from .landing import land_invoices
    from .plans.loads import load_invoices
    from .schemas import INVOICE_SCHEMA
    from .session import scratch_path

    root, table = scratch_path(spark, "invoices-mixed"), scratch_path(spark, "invoice-table")
    raw = fx.invoice_raw(spark, sf_dir)
    odd = F.regexp_extract("file_name", "-([0-9]{2})-", 1).cast("int") % 2 == 1
    land_invoices(spark, raw.where(~odd), root)
    land_invoices(spark, raw.where(odd).select(*[f"`{c}`" for c in reversed(raw.columns)]).drop("Other savings ($)"), root)
    for _ in range(2):
        load_invoices(spark, root, table)
    return spark.read.parquet(table).select(*INVOICE_SCHEMA.names)


@register("stream_usage_upsert", orc.USAGE_FLAT_SQL)
def stream_usage_upsert(spark, sf_dir):
    """Two overlapping pulls land as pages; a file stream upserts each new
    batch into the day-partitioned usage table; the re-read days stay single."""
    from pyspark.sql import functions as F

    from .landing import land_pages
    from .operators.usage import USAGE_KEYS, flatten_usage
    from .session import scratch_path
    from .operators.tables import ORDINAL
    from .sources.buckets import USAGE_RESULT, page_schema
    from .streaming.incremental import stream_upsert

    buckets = fx.usage_buckets(spark, sf_dir)
    day = F.dayofmonth(F.substring("starting_at", 1, 10).cast("date"))
    landing = scratch_path(spark, "usage-stream-landing")
    target = scratch_path(spark, "usage-table")
    ckpt = scratch_path(spark, "usage-stream-ckpt")

    def transform(pages):
        return flatten_usage(pages.select(F.explode("data").alias("b"), ORDINAL).select("b.*", ORDINAL), extra=[ORDINAL])

    # two overlapping pulls land before one run, a third before the next
    parts = [buckets.filter(day <= 15), buckets.filter((day >= 10) & (day <= 20)), buckets.filter(day >= 18)]
    for n, part in enumerate(parts):
        land_pages(spark, part, f"{landing}/pull={n}")
        if n:
            stream_upsert(spark, landing, page_schema(USAGE_RESULT), transform, target, list(USAGE_KEYS), ckpt)
    return ntz(spark.read.parquet(target).select(*flatten_usage(buckets.limit(0)).columns))


@register("stream_late_pull", orc.USAGE_FLAT_SQL)
def stream_late_pull(spark, sf_dir):
    """R1, K2 on condition: three overlapping pulls land and run in the order 0, 2, 1.

    Where pulls share a day the older one has other token counts; the pull that
    lands late fills its own days but undoes nothing of the newer one.
    """
    from pyspark.sql import functions as F

    from .landing import land_pages
    from .operators.tables import ORDINAL
    from .operators.usage import USAGE_KEYS, flatten_usage
    from .session import scratch_path
    from .sources.buckets import USAGE_RESULT, page_schema
    from .streaming.incremental import stream_upsert

    buckets = fx.usage_buckets(spark, sf_dir)
    day = F.dayofmonth(F.substring("starting_at", 1, 10).cast("date"))
    landing, target, ckpt = (scratch_path(spark, f"usage-late-{n}") for n in ("landing", "table", "ckpt"))

    def transform(pages):
        return flatten_usage(pages.select(F.explode("data").alias("b"), ORDINAL).select("b.*", ORDINAL), extra=[ORDINAL])

    def stale(rows, where):
        other = F.transform("results", lambda r: r.withField("output_tokens", F.lit(-1).cast("long")))
        return rows.withColumn("results", F.when(where, other).otherwise(F.col("results")))

    pulls = [stale(buckets.filter(day <= 15), day >= 10), stale(buckets.filter((day >= 10) & (day <= 20)), day >= 18), buckets.filter(day >= 18)]
    for n in (0, 2, 1):
        land_pages(spark, pulls[n], f"{landing}/pull={n}")
        stream_upsert(spark, landing, page_schema(USAGE_RESULT), transform, target, list(USAGE_KEYS), ckpt, keep_ordinal=True)
    return ntz(spark.read.parquet(target).select(*flatten_usage(buckets.limit(0)).columns))


@register("distinct_services", orc.DISTINCT_SERVICES_SQL)
def distinct_services(spark, sf_dir):
    """How many distinct service ids and projects the export holds."""
    from .plans.checks import distinct_values

    b = fx.bill(spark, sf_dir)
    return distinct_values(b, "service.id", "service.id").unionByName(
        distinct_values(b, "project.id", "project.id"))


@register("invoice_month_overlap", orc.month_overlap_sql(LIVE_FROM))
def invoice_month_overlap(spark, sf_dir):
    """Invoice months the live export also covers (kept out of the union)."""
    from pyspark.sql import functions as F

    from .functions.dates import local_midnight_utc
    from .operators.invoice import normalise_invoice
    from .plans.checks import month_overlap

    b = fx.bill(spark, sf_dir)
    start = local_midnight_utc(LIVE_FROM).strftime("%Y-%m-%d %H:%M:%S")
    live = b.filter(F.col("usage_start_time") >= F.expr(f"TIMESTAMP_NTZ '{start}'"))
    return month_overlap(normalise_invoice(fx.invoice_raw(spark, sf_dir)), live)


@register("usage_daily_by_model_workspace", orc.USAGE_DAILY_SQL)
def usage_daily_by_model_workspace(spark, sf_dir):
    """The usage table rolled up to 1d buckets by (model, workspace)."""
    from pyspark.sql import functions as F

    from .operators.usage import flatten_usage

    usage = flatten_usage(fx.usage_buckets(spark, sf_dir))
    return ntz(rp.rollup(usage, "bucket_start", "1d", ["model", "workspace_id"], {
        "uncached_input_tokens": F.sum("uncached_input_tokens"),
        "output_tokens": F.sum("output_tokens"),
        "results": F.count(F.lit(1)),
    }))


@register("coverage_by_service", orc.COVERAGE_BY_SQL)
def coverage_by_service(spark, sf_dir):
    """D2 per service: days each product / category has rows, out of its span."""
    from .plans.checks import coverage_by

    return coverage_by(fx.cur(spark, sf_dir), "cur", "product_name").unionByName(
        coverage_by(fx.cdr(spark, sf_dir), "cdr", "category"))


@register("coverage_bitmap_by_service", orc.COVERAGE_BY_SQL)
def coverage_bitmap_by_service(spark, sf_dir):
    """D2 per service from day bitmaps, each table's made in two overlapping loads and merged."""
    from .plans.checks import coverage_from_bitmaps, day_bitmaps, merge_bitmaps

    def one(df, name, by, split):
        loads = df.where(df.usage_date <= split), df.where(df.usage_date >= split - dt.timedelta(days=3))
        return coverage_from_bitmaps(merge_bitmaps(*(day_bitmaps(d, by) for d in loads)), name)

    return one(fx.cur(spark, sf_dir), "cur", "product_name", dt.date(1996, 1, 1)).unionByName(
        one(fx.cdr(spark, sf_dir), "cdr", "category", dt.date(2024, 1, 15)))


@register("bill_api_arrears", orc.breakdown_sql(AS_OF_SUMMER, offset=-1, projects=API_PROJECTS,
                                                services=API_SERVICES, limit=None))
def bill_api_arrears(spark, sf_dir):
    """Q7 for the API scope: two projects, two services, previous month, no limit."""
    return rp.cost_breakdown(fx.bill(spark, sf_dir), AS_OF_SUMMER, month_offset=-1,
                             projects=API_PROJECTS, services=API_SERVICES, limit=None)


@register("environment_count", orc.ENVIRONMENT_COUNT_SQL)
def environment_count(spark, sf_dir):
    """How many environment tags the cost-and-usage table carries."""
    from .plans.checks import distinct_values

    return distinct_values(fx.cur(spark, sf_dir), "resource_tags_environment", "resource_tags_environment")
