"""DuckDB SQL twins of the fixture views, for the oracle queries.

Each entry is the body of a CTE over the driver's pre-registered tables; an
oracle query names the views it needs and :func:`with_views` prepends them.
"""

from __future__ import annotations

import datetime as dt

# Fixed values, stated here apart from the library's, so that a wrong one there shows.
REPORT_ZONE = "Europe/London"
COMMITMENT_CREDITS = ["COMMITTED_USAGE_DISCOUNT", "COMMITTED_USAGE_DISCOUNT_DOLLAR_BASE", "FEE_UTILIZATION_OFFSET"]
OTHER_CREDITS = ["CREDIT_TYPE_UNSPECIFIED", "PROMOTION", "SUSTAINED_USAGE_DISCOUNT", "DISCOUNT", "FREE_TIER",
                 "SUBSCRIPTION_BENEFIT", "RESELLER_MARGIN"]

VIEW_SQL: dict[str, str] = {}

VIEW_SQL["bill"] = """
SELECT
  {'id': p.p_brand, 'description': p.p_brand} AS service,
  {'id': p.p_type, 'description': p.p_type} AS sku,
  {'id': CAST(l.l_suppkey AS VARCHAR), 'number': CAST(l.l_suppkey + 1000 AS VARCHAR)} AS project,
  CASE WHEN p.p_brand <> 'Brand#2' THEN l.l_extendedprice END AS cost_at_list,
  CASE WHEN l.l_returnflag <> 'N' AND p.p_brand <> 'Brand#2' THEN l.l_extendedprice * (1 - l.l_discount) END
    AS cost_at_effective_price_default,
  CASE WHEN p.p_brand <> 'Brand#2' THEN l.l_extendedprice * (1 - l.l_discount) * (1 - l.l_tax) END AS cost,
  CASE l.l_linenumber WHEN 1 THEN 'tax' WHEN 2 THEN 'adjustment' WHEN 3 THEN NULL ELSE 'regular' END
    AS cost_type,
  l.l_shipdate + to_hours(CAST(l.l_quantity AS INTEGER) % 24) AS usage_start_time,
  CASE l.l_returnflag
    WHEN 'A' THEN [{'type': 'COMMITTED_USAGE_DISCOUNT', 'amount': -l.l_tax * l.l_quantity},
                   {'type': 'PROMOTION', 'amount': -l.l_discount * l.l_quantity}]
    WHEN 'R' THEN CASE WHEN l.l_linenumber = 6 THEN [] ELSE [
      {'type': ['OTHER_UNLISTED', 'COMMITTED_USAGE_DISCOUNT', 'COMMITTED_USAGE_DISCOUNT_DOLLAR_BASE',
                'FEE_UTILIZATION_OFFSET', 'CREDIT_TYPE_UNSPECIFIED', 'PROMOTION', 'SUSTAINED_USAGE_DISCOUNT',
                'DISCOUNT', 'FREE_TIER', 'SUBSCRIPTION_BENEFIT', 'RESELLER_MARGIN'][l.l_orderkey % 11 + 1],
       'amount': CASE WHEN l.l_linenumber <> 5 THEN -l.l_discount * l.l_quantity END}] END
  END AS credits,
  'USD' AS currency
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""

VIEW_SQL["cur"] = """
SELECT
  CAST(l.l_shipdate AS DATE) AS usage_date,
  concat_ws('-', l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber) AS line_item_id,
  'payer-' || CAST(l.l_suppkey % 3 AS VARCHAR) AS bill_payer_account_id,
  CAST(date_trunc('month', CAST(l.l_shipdate AS DATE)) AS DATE) AS bill_billing_period_start_date,
  CAST(l.l_suppkey AS VARCHAR) AS line_item_usage_account_id,
  CASE l.l_linenumber WHEN 1 THEN 'Tax' WHEN 3 THEN NULL ELSE 'Usage' END AS line_item_type,
  l.l_shipdate AS line_item_usage_start_date,
  l.l_shipdate + INTERVAL 1 HOUR AS line_item_usage_end_date,
  p.p_brand AS line_item_product_code,
  p.p_type || '-Usage' AS line_item_usage_type,
  l.l_linestatus AS line_item_operation,
  'qty ' || CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS line_item_description,
  l.l_quantity AS line_item_usage_amount,
  l.l_extendedprice / l.l_quantity AS line_item_unblended_rate,
  l.l_extendedprice AS line_item_unblended_cost,
  p.p_brand AS product_name,
  p.p_type AS product_service_code,
  CASE WHEN l.l_linenumber = 2 THEN NULL ELSE 'eu-west-2' END AS product_region,
  'Hrs' AS pricing_unit,
  CASE WHEN l.l_returnflag = 'R' THEN l.l_extendedprice * (1 - l.l_discount) END AS reservation_effective_cost,
  CASE WHEN l.l_returnflag = 'A' THEN l.l_extendedprice * (1 - l.l_discount) END AS savings_plan_effective_cost,
  p.p_type AS resource_tags_environment,
  CAST(NULL AS VARCHAR) AS resource_tags_transfer_custom_hostname,
  CASE WHEN p.p_type = 'PROMO' THEN 'yes' END AS cost_category_development,
  CASE WHEN p.p_type <> 'PROMO' THEN 'yes' END AS cost_category_production
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""

VIEW_SQL["cdr"] = """
SELECT
  CAST(ts AS DATE) AS usage_date,
  CAST(event_id AS VARCHAR) AS record_id,
  CASE event_type WHEN 'view' THEN 'SMS' WHEN 'click' THEN 'VOICE-CALL' WHEN 'signup' THEN 'VOICE-CALL'
                  WHEN 'purchase' THEN 'VOICE-TTS' WHEN 'error' THEN 'WEBSOCKET-CALL' END AS product,
  CASE WHEN event_type = 'view' AND user_id % 5 = 0 THEN 'outbound'
       WHEN event_type IN ('view', 'signup') THEN 'inbound'
       WHEN event_type = 'click' THEN 'outbound' END AS direction,
  CASE event_type WHEN 'view' THEN 'SMS' WHEN 'error' THEN 'WebSocket'
                  WHEN 'signup' THEN 'Inbound Calls' WHEN 'click' THEN 'Outbound Calls'
                  ELSE 'Other' END AS category,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS total_price,
  CASE WHEN event_type = 'view' THEN '' ELSE 'EUR' END AS currency,
  'net-' || CAST(user_id % 4 AS VARCHAR) AS network,
  'GB' AS country,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status,
  props AS raw
FROM events
"""

VIEW_SQL["usage_results"] = """
SELECT CAST(ts AS DATE) AS day, event_type, user_id % 2 AS parity,
       count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS out_tokens,
       count(*) FILTER (WHERE value > 100) AS big
FROM events GROUP BY 1, 2, 3
"""

VIEW_SQL["usage_flat"] = """
SELECT
  day AS usage_date,
  CAST(day AS TIMESTAMP) AS bucket_start,
  CAST(day + INTERVAL 1 DAY AS TIMESTAMP) AS bucket_end,
  'acct-1' AS account_id,
  CAST(NULL AS VARCHAR) AS api_key_id,
  CASE WHEN parity = 0 THEN NULL ELSE 'w1' END AS workspace_id,
  CAST(NULL AS VARCHAR) AS service_account_id,
  event_type AS model,
  'standard' AS service_tier,
  '0-200k' AS context_window,
  'global' AS inference_geo,
  n AS uncached_input_tokens,
  n AS cache_read_input_tokens,
  CASE WHEN event_type = 'error' THEN NULL ELSE n END AS cache_creation_ephemeral_5m_input_tokens,
  CASE WHEN event_type = 'error' THEN NULL ELSE n END AS cache_creation_ephemeral_1h_input_tokens,
  out_tokens AS output_tokens,
  CASE WHEN event_type = 'view' THEN NULL ELSE big END AS web_search_requests
FROM usage_results
"""

VIEW_SQL["orders_monthly"] = """
SELECT month, sid, list_c, neg_c, sp_c, list_c + neg_c + sp_c AS sub_c
FROM (
  SELECT month, sid, list_c, -(list_c // 10) AS neg_c, -(list_c // 20) AS sp_c
  FROM (
    SELECT CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS month,
           o_orderpriority AS sid,
           CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(26,9))) AS DECIMAL(18,2)) * 100 AS BIGINT) AS list_c
    FROM orders GROUP BY 1, 2))
"""

# Dependencies between the SQL views (a view must follow the ones it reads).
VIEW_DEPS = {"usage_flat": ["usage_results"]}


def with_views(body: str, *views: str) -> str:
    ordered: list[str] = []

    def add(v: str) -> None:
        for d in VIEW_DEPS.get(v, []):
            add(d)
        if v not in ordered:
            ordered.append(v)

    for v in views:
        add(v)
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v]})" for v in ordered)
    return f"WITH {ctes}\n{body}"


def sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def month_start(as_of: dt.date, offset: int = 0) -> str:
    return f"CAST(date_trunc('month', DATE '{as_of.isoformat()}') + INTERVAL ({offset}) MONTH AS DATE)"


def london_bound(day: str) -> str:
    """The UTC time at which the day that an SQL expression gives begins in the reports' zone."""
    return f"((CAST({day} AS TIMESTAMP) AT TIME ZONE '{REPORT_ZONE}') AT TIME ZONE 'UTC')"


def month_literals(as_of: dt.date, offset: int = 0) -> tuple[str, str]:
    return month_start(as_of, offset), month_start(as_of, offset + 1)


def credit_sum_sql(types) -> str:
    return (f"coalesce(list_sum(list_transform(list_filter(credits, lambda c: c.type IN ({sql_list(types)}) "
            f"AND c.amount IS NOT NULL), lambda c: CAST(c.amount AS DECIMAL(26,9)))), 0)")


CUD_SQL = credit_sum_sql(COMMITMENT_CREDITS)
OTHER_SQL = credit_sum_sql(OTHER_CREDITS)


def breakdown_sql(as_of: dt.date, *, offset: int = 0, projects=None, services=None,
                  fee_skus=None, limit: int | None = 10) -> str:
    """The month report from a ledger: one entry per amount (list, net and effective price,
    fee, each credit on its own), summed by kind."""
    lo, hi = month_literals(as_of, offset)
    wanted = [f"usage_start_time BETWEEN {london_bound(lo)} AND {london_bound(hi)} - INTERVAL 1 MICROSECOND",
              "cost_type NOT IN ('tax', 'adjustment')"]
    if projects is not None:
        wanted.append(f"list_has_any([project.id, project.number], [{sql_list(projects)}])")
    if services is not None:
        wanted.append(f"list_contains([{sql_list(services)}], service.id)")
    fee = f"sku.id IN ({sql_list(fee_skus)})" if fee_skus else "false"

    def total(kind: str) -> str:
        # A service without a price has no sum of prices; one without fees or credits has 0 of them.
        plain = f"sum(amount) FILTER (WHERE kind = '{kind}')"
        return plain if kind in ("list", "net", "effective") else f"coalesce({plain}, 0)"

    def money(sums: str, name: str) -> str:
        return f'CAST({sums} AS DECIMAL(38,9)) AS "{name}"'

    return with_views(f""", month_rows AS (
  SELECT service.description AS name, * FROM bill WHERE {" AND ".join(wanted)}),
entries AS (
  SELECT name, 'list' AS kind, cost_at_list AS x FROM month_rows
  UNION ALL SELECT name, 'net', cost FROM month_rows
  UNION ALL SELECT name, 'effective', coalesce(cost_at_effective_price_default, cost) FROM month_rows
  UNION ALL SELECT name, 'fee', cost FROM month_rows WHERE {fee}
  UNION ALL SELECT name, CASE WHEN c.type IN ({sql_list(COMMITMENT_CREDITS)}) THEN 'commitment'
                              WHEN c.type IN ({sql_list(OTHER_CREDITS)}) THEN 'other' ELSE 'unlisted' END, c.amount
            FROM (SELECT name, unnest(credits) AS c FROM month_rows)),
ledger AS (SELECT name, kind, CAST(x AS DECIMAL(26,9)) AS amount FROM entries)
SELECT name AS "Service Description",
       {money(f"{total('list')} - {total('fee')}", "Cost")},
       {money(f"{total('effective')} - {total('list')}", "Negotiated savings")},
       {money(f"{total('fee')} + {total('net')} - {total('effective')} + {total('commitment')}", "Savings programmes")},
       {money(total('other'), "Other savings")},
       {money(f"{total('net')} + {total('commitment')} + {total('other')}", "Subtotal")}
FROM ledger GROUP BY name
ORDER BY "Subtotal" DESC NULLS LAST, "Service Description" {f"LIMIT {limit}" if limit else ""}
""", "bill")


def credit_rows_sql() -> str:
    return with_views(f"""
SELECT service.id AS service_id, project.id AS project_id, usage_start_time, cost_type,
       CAST(coalesce(len(credits), -1) AS INTEGER) AS n_credits,
       CAST({CUD_SQL} AS DECIMAL(26,9)) AS cud_credits,
       CAST({OTHER_SQL} AS DECIMAL(26,9)) AS other_savings
FROM bill""", "bill")


def round2(expr: str) -> str:
    return f"CAST(round(sum(CAST({expr} AS DECIMAL(28,15))), 2) AS DOUBLE)"


def cur_by_service_sql(as_of: dt.date, *, offset: int = 0, label: str = "Service Description",
                       effective: bool = False, limit: int | None = 10) -> str:
    lo, hi = month_literals(as_of, offset)
    extra = ""
    if effective:
        extra = (f', {round2("reservation_effective_cost")} AS "Reservation effective cost"'
                 f', {round2("savings_plan_effective_cost")} AS "Savings plan effective cost"')
    lim = f"LIMIT {limit}" if limit else ""
    return with_views(f"""
SELECT product_name AS "{label}", {round2("line_item_unblended_cost")} AS "Cost" {extra}
FROM cur
WHERE line_item_type != 'Tax' AND usage_date >= {lo} AND usage_date < {hi}
GROUP BY product_name
ORDER BY "Cost" DESC NULLS LAST, "{label}" {lim}""", "cur")


def cur_by_environment_sql(as_of: dt.date, offset: int = 0) -> str:
    lo, hi = month_literals(as_of, offset)
    return with_views(f"""
SELECT resource_tags_environment AS environment, {round2("line_item_unblended_cost")} AS "Cost",
       count(*) AS line_items
FROM cur
WHERE line_item_type != 'Tax' AND usage_date >= {lo} AND usage_date < {hi}
GROUP BY resource_tags_environment""", "cur")


def cdr_by_category_sql(as_of: dt.date, offset: int = 0) -> str:
    lo, hi = month_literals(as_of, offset)
    return with_views(f"""
SELECT category AS "Service Description", {round2("total_price")} AS "Cost"
FROM cdr
WHERE usage_date >= {lo} AND usage_date < {hi}
GROUP BY category ORDER BY "Cost" DESC NULLS LAST, "Service Description" """, "cdr")


def side_by_side_sql(bill_as_of: dt.date, cur_as_of: dt.date, cdr_as_of: dt.date) -> str:
    gcp = breakdown_sql(bill_as_of, limit=None)
    aws = cur_by_service_sql(cur_as_of, limit=None)
    tel = cdr_by_category_sql(cdr_as_of)
    return f"""
SELECT 'gcp' AS source, 'USD' AS currency, "Service Description" AS service,
       CAST(round("Subtotal", 2) AS DOUBLE) AS cost FROM ({gcp})
UNION ALL
SELECT 'aws', 'USD', "Service Description", "Cost" FROM ({aws})
UNION ALL
SELECT 'cdr', 'EUR', "Service Description", "Cost" FROM ({tel})"""


CUR_TABLE_SQL = with_views("SELECT * FROM cur", "cur")

CDR_TABLE_SQL = with_views("""
SELECT usage_date, record_id, product, direction, category, total_price, currency, network,
       country, status FROM cdr""", "cdr")

CDR_FALLBACK_SQL = with_views(
    "SELECT product, count(*) AS rows, count(*) AS ids FROM cdr GROUP BY product", "cdr")

CDR_PROMOTED_SQL = with_views("""
SELECT record_id, status AS raw_status, CAST(json_extract(raw, '$.k') AS BIGINT) AS client_k
FROM cdr""", "cdr")


def usage_key_sql(day: str, dims: list[str]) -> str:
    parts = ", ".join([f"CAST({day} AS VARCHAR)"] + [f"coalesce({d}, 'None')" for d in dims])
    return f"sha256(concat_ws('|', {parts}))"


USAGE_DIMS = ["account_id", "api_key_id", "workspace_id", "service_account_id", "model",
              "service_tier", "context_window", "inference_geo"]

USAGE_FLAT_SQL = with_views(f"""
SELECT usage_date, {usage_key_sql('usage_date', USAGE_DIMS)} AS record_id, bucket_start, bucket_end,
       {", ".join(USAGE_DIMS)}, uncached_input_tokens, cache_read_input_tokens,
       cache_creation_ephemeral_5m_input_tokens, cache_creation_ephemeral_1h_input_tokens,
       output_tokens, web_search_requests
FROM usage_flat""", "usage_flat")

COST_FLAT_SQL = with_views(f"""
SELECT usage_date, {usage_key_sql('usage_date', ['workspace_id', 'description', 'cost_type', 'token_type',
                                                 'model', 'service_tier', 'context_window', 'inference_geo'])}
         AS record_id,
       bucket_start, bucket_end, workspace_id, description, cost_type, token_type, model, service_tier,
       context_window, inference_geo, currency, amount_usd
FROM (
  SELECT day AS usage_date, CAST(day AS TIMESTAMP) AS bucket_start,
         CAST(day + INTERVAL 1 DAY AS TIMESTAMP) AS bucket_end,
         CASE WHEN parity = 0 THEN NULL ELSE 'w1' END AS workspace_id,
         event_type || ' tokens' AS description, 'tokens' AS cost_type,
         'uncached_input_tokens' AS token_type, event_type AS model, 'standard' AS service_tier,
         '0-200k' AS context_window, 'global' AS inference_geo, 'USD' AS currency,
         CAST(n AS DOUBLE) AS amount_usd
  FROM usage_results)""", "usage_results")

USAGE_TOTAL_INPUT_SQL = with_views("""
SELECT usage_date, model,
       CAST(sum(coalesce(uncached_input_tokens, 0) + coalesce(cache_read_input_tokens, 0)
           + coalesce(cache_creation_ephemeral_5m_input_tokens, 0)
           + coalesce(cache_creation_ephemeral_1h_input_tokens, 0)) AS BIGINT) AS total_input_tokens,
       CAST(sum(coalesce(output_tokens, 0)) AS BIGINT) AS output_tokens
FROM usage_flat GROUP BY usage_date, model""", "usage_flat")

USAGE_ROLLUP_SQL = """
SELECT date_trunc('hour', ts) AS bucket_start, event_type, count(*) AS events,
       CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS output_tokens,
       CAST(round(sum(CAST(value AS DECIMAL(26,9))), 2) AS DOUBLE) AS value
FROM events GROUP BY 1, 2"""

USAGE_ROLLUP_MINUTES_SQL = """
SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS bucket_start, event_type, count(*) AS events,
       CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS output_tokens
FROM events GROUP BY 1, 2"""

INVOICE_TABLE_SQL = with_views("""
SELECT month AS invoice_month, 'Priority ' || sid AS service_description, sid AS service_id,
       CAST(list_c AS DOUBLE) / 100 AS list_cost,
       CAST(neg_c AS DOUBLE) / 100 AS negotiated_savings,
       CAST(sp_c AS DOUBLE) / 100 AS savings_programmes,
       CAST(0 AS DOUBLE) AS other_savings,
       CAST(sub_c AS DOUBLE) / 100 AS unrounded_subtotal,
       CAST(sub_c AS DOUBLE) / 100 AS subtotal,
       CASE WHEN prev IS NULL THEN 'New' ELSE CAST(((sub_c - prev) * 100) // prev AS VARCHAR) END
         AS percent_change_vs_previous
FROM (SELECT *, lag(sub_c) OVER (PARTITION BY sid ORDER BY month) AS prev FROM orders_monthly)""",
                               "orders_monthly")

# Odd months' files lack the column.
INVOICE_MIXED_SQL = f"""
SELECT * REPLACE (CASE WHEN month(invoice_month) % 2 = 0 THEN other_savings END AS other_savings)
FROM ({INVOICE_TABLE_SQL})"""

INVOICE_RECONCILE_SQL = with_views("""
SELECT month AS invoice_month, count(*) AS services,
       CAST(round(sum(CAST(CAST(sub_c AS DOUBLE) / 100 AS DECIMAL(26,9))), 2) AS DOUBLE) AS services_subtotal,
       CAST(round(CAST(CAST(sum(sub_c) AS DOUBLE) / 100 AS DECIMAL(26,9)), 2) AS DOUBLE) AS footer_subtotal,
       CAST(round(sum(CAST(CAST(sub_c AS DOUBLE) / 100 AS DECIMAL(26,9)))
                  - CAST(CAST(sum(sub_c) AS DOUBLE) / 100 AS DECIMAL(26,9)), 2) AS DOUBLE) AS difference,
       round(sum(CAST(CAST(sub_c AS DOUBLE) / 100 AS DECIMAL(26,9)))
             - CAST(CAST(sum(sub_c) AS DOUBLE) / 100 AS DECIMAL(26,9)), 2) = 0 AS matches
FROM orders_monthly GROUP BY month""", "orders_monthly")

BILLING_PERIODS_SQL = """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM orders),
m AS (SELECT as_of, CAST(date_trunc('month', as_of) AS DATE) AS ms FROM d)
SELECT as_of, strftime(ms, '%Y%m%d') || '-' || strftime(ms + INTERVAL 1 MONTH, '%Y%m%d') AS period,
       false AS is_previous FROM m
UNION ALL
SELECT as_of, strftime(ms - INTERVAL 1 MONTH, '%Y%m%d') || '-' || strftime(ms, '%Y%m%d'), true
FROM m WHERE day(as_of) <= 7"""


def lookback_sql(as_of: dt.date, days: int) -> str:
    return with_views(f"""
SELECT record_id, usage_date, product, total_price FROM cdr
WHERE usage_date >= DATE '{as_of.isoformat()}' - INTERVAL {days} DAY
  AND usage_date < DATE '{as_of.isoformat()}'""", "cdr")


CDR_COLS = ("usage_date, record_id, product, direction, category, total_price, currency, network, "
            "country, status, raw")


def _cdr_split(where: str, bump: float) -> str:
    return (f"SELECT usage_date, record_id, product, direction, category, total_price + {bump} AS total_price, "
            f"currency, network, country, status, raw FROM cdr WHERE {where}")


def _merge_sql(target: str, source: str) -> str:
    return (f"SELECT {CDR_COLS} FROM ({target}) t WHERE NOT EXISTS (SELECT 1 FROM ({source}) s "
            f"WHERE s.usage_date = t.usage_date AND s.record_id = t.record_id) "
            f"UNION ALL SELECT {CDR_COLS} FROM ({source})")


UPSERT_TARGET = f"SELECT {CDR_COLS} FROM cdr WHERE product <> 'VOICE-TTS'"
UPSERT_SOURCE = _cdr_split("product IN ('SMS', 'VOICE-TTS')", 1)
UPSERT_SQL = with_views(_merge_sql(UPSERT_TARGET, UPSERT_SOURCE), "cdr")

LAST_WINS_SOURCE = f"""
SELECT {CDR_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY usage_date, record_id ORDER BY ord DESC) AS rn FROM (
    SELECT *, 1 AS ord FROM ({_cdr_split("product IN ('SMS', 'VOICE-CALL')", 1)})
    UNION ALL
    SELECT *, 2 AS ord FROM ({_cdr_split("product IN ('VOICE-CALL', 'WEBSOCKET-CALL')", 2)})))
WHERE rn = 1"""
LAST_WINS_SQL = with_views(_merge_sql(f"SELECT {CDR_COLS} FROM cdr WHERE product <> 'WEBSOCKET-CALL'",
                                      LAST_WINS_SOURCE), "cdr")

REPLACE_SOURCE = _cdr_split("product = 'SMS' AND usage_date >= DATE '2024-01-14' AND usage_date < DATE '2024-01-17'", 1)
REPLACE_DAYS_SQL = with_views(f"""
SELECT {CDR_COLS} FROM cdr WHERE usage_date NOT IN (SELECT usage_date FROM ({REPLACE_SOURCE}))
UNION ALL SELECT {CDR_COLS} FROM ({REPLACE_SOURCE})""", "cdr")

UPSERT_TWICE_SQL = with_views(f"""
SELECT r.run, count(*) AS rows, CAST(round(sum(CAST(m.total_price AS DECIMAL(26,9))), 2) AS DOUBLE) AS total_price
FROM ({_merge_sql(UPSERT_TARGET, UPSERT_SOURCE)}) m, (VALUES (1), (2)) r(run)
GROUP BY r.run""", "cdr")

DUPLICATE_KEYS_SQL = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
DUPLICATE_SUSPECTS_SQL = """
SELECT l_partkey, l_shipdate, count(*) AS n FROM lineitem
GROUP BY l_partkey, l_shipdate HAVING count(*) > 1"""
# First day of the load that the fixture appends twice.
APPENDED_FROM = dt.date(2001, 10, 1)
CUR_DUPLICATES_SQL = with_views(f"""
SELECT usage_date, line_item_id, count(*) AS n
FROM (SELECT usage_date, line_item_id FROM cur UNION ALL SELECT usage_date, line_item_id FROM cur WHERE usage_date >= DATE '{APPENDED_FROM}')
GROUP BY usage_date, line_item_id HAVING count(*) > 1""", "cur")


def freshness_sql(cdr_as_of: dt.date, cur_as_of: dt.date) -> str:
    def one(name: str, as_of: dt.date) -> str:
        return (f"SELECT '{name}' AS \"table\", min(usage_date) AS first_date, max(usage_date) AS last_date, "
                f"CAST(DATE '{as_of}' - max(usage_date) AS INTEGER) AS lag_days, "
                f"DATE '{as_of}' - max(usage_date) <= 2 AS fresh FROM {name}")
    return with_views(f"{one('cdr', cdr_as_of)} UNION ALL {one('cur', cur_as_of)}", "cdr", "cur")


COVERAGE_SQL = with_views(" UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", min(usage_date) AS first_date, max(usage_date) AS last_date, "
    f"count(DISTINCT usage_date) AS days_present, "
    f"CAST(max(usage_date) - min(usage_date) + 1 AS INTEGER) AS days_in_span FROM {t}"
    for t in ("cdr", "cur")), "cdr", "cur")

COVERAGE_GAPS_SQL = with_views(" UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", CAST(d AS DATE) AS day FROM "
    f"(SELECT unnest(generate_series(min(usage_date), max(usage_date), INTERVAL 1 DAY)) AS d FROM {t}) "
    f"WHERE CAST(d AS DATE) NOT IN (SELECT usage_date FROM {t})"
    for t in ("cdr", "cur")), "cdr", "cur")


def scope_audit_sql(projects, services) -> str:
    def one(scope: str, ids, cols) -> str:
        vals = ", ".join(f"('{i}')" for i in dict.fromkeys(ids))
        arr = ", ".join(cols)
        return (f"SELECT '{scope}' AS scope, c.configured_id, coalesce(h.rows, 0) AS rows, "
                f"h.rows IS NOT NULL AS matched FROM (VALUES {vals}) c(configured_id) LEFT JOIN "
                f"(SELECT x AS configured_id, count(*) AS rows FROM (SELECT unnest(list_distinct([{arr}])) AS x FROM bill) "
                f"WHERE x IN ({sql_list(ids)}) GROUP BY x) h ON c.configured_id = h.configured_id")
    return with_views(one("project", projects, ["project.id", "project.number"]) + " UNION ALL "
                      + one("service", services, ["service.id"]), "bill")


def scope_suggestions_sql(projects, services) -> str:
    """Near misses by comparing every configured id without a match with every id of the export."""
    def one(scope: str, ids, cols) -> str:
        vals = ", ".join(f"('{i}')" for i in dict.fromkeys(ids))
        return (f"SELECT '{scope}' AS scope, configured_id, suggestion, CAST(levenshtein(w, h) AS INTEGER) AS distance FROM "
                f"(SELECT configured_id, lower(regexp_replace(configured_id, '.*/', '')) AS w FROM (VALUES {vals}) c(configured_id)) c, "
                f"(SELECT DISTINCT x AS suggestion, lower(regexp_replace(x, '.*/', '')) AS h FROM (SELECT unnest([{', '.join(cols)}]) AS x FROM bill) WHERE x IS NOT NULL) "
                f"WHERE levenshtein(w, h) <= 1 AND configured_id NOT IN (SELECT unnest([{', '.join(cols)}]) FROM bill)")
    return with_views(one("project", projects, ["project.id", "project.number"]) + " UNION ALL "
                      + one("service", services, ["service.id"]), "bill")


LOCAL_MONTH = ("CAST(date_trunc('month', timezone('Europe/London', usage_start_time AT TIME ZONE 'UTC')) "
               "AS DATE)")


def month_sources_sql(live_from: dt.date) -> str:
    inv = INVOICE_TABLE_SQL.split("\nSELECT month AS invoice_month", 1)
    return f"""{inv[0]},
bill AS ({VIEW_SQL["bill"]}),
invoice AS (SELECT month AS invoice_month{inv[1]}),
live AS (
  SELECT {LOCAL_MONTH} AS month, 'live' AS source,
         CAST(round(sum(CAST(cost_at_list AS DECIMAL(26,9))), 2) AS DOUBLE) AS list_cost,
         CAST(round(sum(CAST(cost AS DECIMAL(26,9))), 2) AS DOUBLE) AS cost
  FROM bill WHERE usage_start_time >= {london_bound(f"DATE '{live_from}'")} GROUP BY 1),
inv AS (
  SELECT invoice_month AS month, 'invoice' AS source,
         CAST(round(sum(CAST(list_cost AS DECIMAL(26,9))), 2) AS DOUBLE) AS list_cost,
         CAST(round(sum(CAST(subtotal AS DECIMAL(26,9))), 2) AS DOUBLE) AS cost
  FROM invoice GROUP BY 1)
SELECT * FROM inv WHERE month NOT IN (SELECT month FROM live)
UNION ALL SELECT * FROM live"""


LOAD_SUMMARY_SQL = """
SELECT CASE event_type WHEN 'view' THEN 'SMS' WHEN 'click' THEN 'VOICE-CALL' WHEN 'signup' THEN 'VOICE-CALL'
                       WHEN 'purchase' THEN 'VOICE-TTS' WHEN 'error' THEN 'WEBSOCKET-CALL' END AS product,
       CASE WHEN event_type IN ('view', 'signup') THEN 'inbound' WHEN event_type = 'click' THEN 'outbound' END
         AS direction_requested,
       count(*) AS rows, min(CAST(ts AS DATE)) AS first_date, max(CAST(ts AS DATE)) AS last_date
FROM events GROUP BY 1, 2"""


DISTINCT_SERVICES_SQL = with_views("""
SELECT 'service.id' AS "column", count(DISTINCT service.id) AS distinct_values FROM bill
UNION ALL
SELECT 'project.id', count(DISTINCT project.id) FROM bill""", "bill")


def month_overlap_sql(live_from: dt.date) -> str:
    return with_views(f"""
SELECT DISTINCT month AS invoice_month FROM orders_monthly
WHERE month IN (SELECT {LOCAL_MONTH} FROM bill WHERE usage_start_time >= {london_bound(f"DATE '{live_from}'")})""",
                      "orders_monthly", "bill")


USAGE_DAILY_SQL = with_views("""
SELECT date_trunc('day', bucket_start) AS bucket_start, model, workspace_id,
       CAST(sum(uncached_input_tokens) AS BIGINT) AS uncached_input_tokens,
       CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
       count(*) AS results
FROM usage_flat GROUP BY 1, 2, 3""", "usage_flat")


COVERAGE_BY_SQL = with_views(" UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", {g} AS \"group\", min(usage_date) AS first_date, max(usage_date) AS last_date, "
    f"count(DISTINCT usage_date) AS days_present, "
    f"CAST(max(usage_date) - min(usage_date) + 1 AS INTEGER) AS days_in_span FROM {t} GROUP BY {g}"
    for t, g in (("cur", "product_name"), ("cdr", "category"))), "cdr", "cur")


ENVIRONMENT_COUNT_SQL = with_views("""
SELECT 'resource_tags_environment' AS "column", count(DISTINCT resource_tags_environment) AS distinct_values
FROM cur""", "cur")
