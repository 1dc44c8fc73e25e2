"""DuckDB-runnable SQL for each registered query, written independently of the DataFrame code.

The fixture is written here as plain ``UNION ALL`` SQL (the Spark side uses one scan and an explode),
dedup as a ``row_number`` window, checks as ``FULL OUTER JOIN``s, integrity with ``IS NOT DISTINCT FROM``.
DuckDB types a BIGINT sum as HUGEINT, so sums are cast back to BIGINT; a DOUBLE -> BIGINT cast rounds
in DuckDB but truncates in Spark, so truncation is spelled out with ``trunc``.
"""

from __future__ import annotations

BRONZE_COLS = (
    "event_id, account_id, amount_minor, signed_amount_minor, currency, direction, transaction_type, "
    "occurred_at, event_date, source_system, ingested_at, batch_id"
)
SILVER_COLS = (
    "event_id, account_id, amount_minor, signed_amount_minor, currency, direction, transaction_type, "
    "occurred_at, business_date, source_system, ingested_at, batch_id"
)
FACT_COLS = (
    "event_id, account_id, currency, business_date, occurred_at, direction, transaction_type, "
    "signed_amount_minor, source_system"
)


def base_events(faulty: bool) -> str:
    minor = "CAST(round(value * 100) AS BIGINT)"
    signed = f"CASE WHEN event_type IN ('purchase', 'error') THEN -abs({minor}) ELSE abs({minor}) END"
    event_id = "concat('EVT-', lpad(CAST(event_id AS VARCHAR), 8, '0'))"
    currency = "CASE WHEN event_id % 3 = 0 THEN 'GBP' WHEN event_id % 3 = 1 THEN 'EUR' ELSE 'USD' END"
    amount = minor
    if faulty:
        event_id = f"CASE WHEN event_id % 997 = 7 THEN NULL ELSE {event_id} END"
        amount = f"CASE WHEN event_id % 499 = 3 THEN 0 ELSE {minor} END"
        signed = f"CASE WHEN event_id % 797 = 2 THEN NULL WHEN event_id % 499 = 3 THEN 0 ELSE {signed} END"
        currency = f"CASE WHEN event_id % 401 = 1 THEN NULL ELSE {currency} END"
    return f"""SELECT
    {event_id} AS event_id,
    concat('ACC-', lpad(CAST(user_id AS VARCHAR), 5, '0')) AS account_id,
    {amount} AS amount_minor,
    {signed} AS signed_amount_minor,
    {currency} AS currency,
    CASE WHEN event_type IN ('purchase', 'error') THEN 'debit' ELSE 'credit' END AS direction,
    CASE event_type WHEN 'click' THEN 'card_payment' WHEN 'error' THEN 'fee' WHEN 'purchase' THEN 'transfer'
         WHEN 'signup' THEN 'refund' WHEN 'view' THEN 'fx_conversion' END AS transaction_type,
    ts AS occurred_at,
    CAST(ts AS DATE) AS event_date,
    'core-ledger' AS source_system,
    event_id AS _src
  FROM events"""


def fixture_ctes(faulty: bool = True, prefix: str = "") -> str:
    """CTEs ``{p}base``, ``{p}bronze``, ``{p}dedup``, ``{p}classified``, ``{p}silver``, ``{p}rejected``."""
    p = prefix
    return f"""{p}base AS ({base_events(faulty)}),
{p}bronze AS (
  SELECT {BRONZE_COLS.replace('ingested_at, batch_id', "occurred_at + INTERVAL 1 MINUTE AS ingested_at, 'b1' AS batch_id")}, _src FROM {p}base
  UNION ALL
  SELECT {BRONZE_COLS.replace('ingested_at, batch_id', "occurred_at + INTERVAL 6 MINUTE, 'b2'")}, _src FROM {p}base WHERE _src % 33 = 0
  UNION ALL
  SELECT {BRONZE_COLS.replace('ingested_at, batch_id', "occurred_at + INTERVAL 1 MINUTE, 'b3'")}, _src FROM {p}base WHERE _src % 101 = 5
),
{after_bronze_ctes(f"{p}bronze", p)}"""


def after_bronze_ctes(bronze: str, prefix: str = "") -> str:
    """The layers built from a bronze relation."""
    p = prefix
    return f"""{p}dedup AS (
  SELECT {BRONZE_COLS}, _src FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
        ORDER BY ingested_at ASC NULLS LAST, batch_id ASC NULLS LAST, _src ASC NULLS LAST) AS _rn
    FROM {bronze} WHERE event_id IS NOT NULL) ranked
  WHERE _rn = 1
  UNION ALL
  SELECT {BRONZE_COLS}, _src FROM {bronze} WHERE event_id IS NULL
),
{p}classified AS (
  SELECT *, CASE
      WHEN coalesce(event_id IS NOT NULL AND currency IS NOT NULL AND signed_amount_minor <> 0, false) THEN NULL
      WHEN event_id IS NULL THEN 'missing_event_id'
      WHEN currency IS NULL THEN 'missing_currency'
      WHEN signed_amount_minor = 0 THEN 'zero_amount'
      ELSE 'unknown' END AS rejection_reason
  FROM {p}dedup
),
{p}silver AS (
  SELECT {SILVER_COLS.replace('business_date', 'CAST(occurred_at AS DATE) AS business_date')}
  FROM {p}classified WHERE rejection_reason IS NULL
),
{p}rejected AS (
  SELECT {BRONZE_COLS}, rejection_reason FROM {p}classified WHERE rejection_reason IS NOT NULL
),
{p}gold AS (SELECT {FACT_COLS} FROM {p}silver),
{p}gold_fault AS (SELECT {FACT_COLS} FROM {p}silver WHERE transaction_type <> 'fx_conversion'),
{p}dim AS (
  SELECT account_id, min(occurred_at) AS first_seen_at, max(occurred_at) AS last_seen_at,
         count(*) AS transaction_count, CAST(sum(signed_amount_minor) AS BIGINT) AS net_amount_minor
  FROM {p}silver GROUP BY account_id
),
{p}dim_fault AS (
  SELECT account_id, min(occurred_at) AS first_seen_at, max(occurred_at) AS last_seen_at,
         count(*) AS transaction_count, CAST(sum(signed_amount_minor) AS BIGINT) AS net_amount_minor
  FROM {p}gold_fault GROUP BY account_id
)"""


def totals_sql(source: str, layer: str, date_expr: str = "CAST(occurred_at AS DATE)", key: str = "event_id",
               amount: str = "signed_amount_minor") -> str:
    return f"""SELECT '{layer}' AS layer, coalesce(CAST({date_expr} AS VARCHAR), 'None') AS partition_key,
    count(*) AS row_count, CAST(coalesce(sum({amount}), 0) AS BIGINT) AS amount_minor_sum,
    count(DISTINCT {key}) AS distinct_event_ids
  FROM {source} GROUP BY 2"""


def row_check_sql(src: str, tgt: str, source_layer: str, target_layer: str, *, distinct_source: bool = False,
                  distinct_target: bool = False, check: str = "row_count", evaluated: bool = False) -> str:
    s_val = "s.distinct_event_ids" if distinct_source else "s.row_count"
    t_val = "t.distinct_event_ids" if distinct_target else "t.row_count"
    exp, act = f"coalesce({s_val}, 0)", f"coalesce({t_val}, 0)"
    select = f"""SELECT '{check}' AS "check", coalesce(s.partition_key, t.partition_key) AS partition_key,
    '{source_layer}' AS source_layer, '{target_layer}' AS target_layer,
    CAST({exp} AS BIGINT) AS expected, CAST({act} AS BIGINT) AS actual, CAST({act} - {exp} AS BIGINT) AS delta,
    'error' AS severity,
    CASE WHEN t.partition_key IS NULL THEN 'partition missing from target layer'
         WHEN s.partition_key IS NULL THEN 'partition present in target but absent from source'
         ELSE '' END AS note,
    {exp} <> {act} AS is_break
  FROM {src} s FULL OUTER JOIN {tgt} t ON s.partition_key = t.partition_key"""
    return select if evaluated else f"SELECT * EXCLUDE (is_break) FROM ({select}) WHERE is_break"


def amount_check_sql(src: str, tgt: str, source_layer: str, target_layer: str, *, tolerance: int = 0,
                     relative: float = 0.0, check: str = "amount_sum", evaluated: bool = False) -> str:
    exp, act = "coalesce(s.amount_minor_sum, 0)", "coalesce(t.amount_minor_sum, 0)"
    drift = f"abs({act} - {exp})"
    allowed = f"greatest(CAST({tolerance} AS BIGINT), CAST(trunc(abs({exp}) * {float(relative)!r}) AS BIGINT))"
    select = f"""SELECT '{check}' AS "check", coalesce(s.partition_key, t.partition_key) AS partition_key,
    '{source_layer}' AS source_layer, '{target_layer}' AS target_layer,
    CAST({exp} AS BIGINT) AS expected, CAST({act} AS BIGINT) AS actual, CAST({act} - {exp} AS BIGINT) AS delta,
    'error' AS severity,
    printf('drift %d minor units exceeds allowance %d', {drift}, {allowed}) AS note,
    {drift} > {allowed} AS is_break
  FROM {src} s FULL OUTER JOIN {tgt} t ON s.partition_key = t.partition_key"""
    return select if evaluated else f"SELECT * EXCLUDE (is_break) FROM ({select}) WHERE is_break"


def dedup_check_sql(subject: str, *, evaluated: bool = False) -> str:
    select = f"""SELECT 'deduplication' AS "check", partition_key, layer AS source_layer, layer AS target_layer,
    distinct_event_ids AS expected, row_count AS actual, CAST(row_count - distinct_event_ids AS BIGINT) AS delta,
    'error' AS severity, 'duplicate event ids survived into this layer' AS note,
    row_count <> distinct_event_ids AS is_break
  FROM {subject}"""
    return select if evaluated else f"SELECT * EXCLUDE (is_break) FROM ({select}) WHERE is_break"


def integrity_sql(fact_keys: str, dim_keys: str, *, dimension: str, severity: str = "error",
                  evaluated: bool = False) -> str:
    """``fact_keys`` / ``dim_keys`` are relations with one column ``k``."""
    select = f"""SELECT 'referential_integrity' AS "check",
    concat('{dimension}:', coalesce(CAST(f.k AS VARCHAR), 'None')) AS partition_key,
    'gold' AS source_layer, 'gold' AS target_layer, CAST(1 AS BIGINT) AS expected, CAST(0 AS BIGINT) AS actual,
    CAST(-1 AS BIGINT) AS delta, '{severity}' AS severity,
    'fact references {dimension} key with no dimension row' AS note,
    NOT EXISTS (SELECT 1 FROM {dim_keys} d WHERE d.k IS NOT DISTINCT FROM f.k) AS is_break
  FROM (SELECT DISTINCT k FROM {fact_keys}) f"""
    return select if evaluated else f"SELECT * EXCLUDE (is_break) FROM ({select}) WHERE is_break"


def summary_sql(evaluated: str, step: int, check: str, source_layer: str, target_layer: str) -> str:
    return f"""SELECT {step} AS step, '{check}' AS "check", '{source_layer}' AS source_layer,
    '{target_layer}' AS target_layer, count(*) FILTER (WHERE is_break AND severity = 'error') = 0 AS passed,
    count(*) AS partitions_compared, count(*) FILTER (WHERE is_break) AS breaks
  FROM ({evaluated}) e"""
