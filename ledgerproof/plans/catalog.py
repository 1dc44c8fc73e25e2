"""Registered queries: each takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the given tables.

Every query reads whole tables (``events``, ``orders``, ``lineitem``, ``customer``) or data Spark
derives from them; the matching DuckDB SQL lives in ``ORACLE``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.functions.money import amount_major, minor_units
from ledgerproof.operators import checks as C
from ledgerproof.operators.control_totals import (
    control_totals,
    duplicate_keys,
    invariant_violations,
    manifest_totals,
    source_manifest,
)
from ledgerproof.operators.dedup import dedup_bronze, first_arrival
from ledgerproof.operators.medallion import (
    account_lookup,
    account_summary,
    classify,
    dim_account,
    drop_fx_conversions,
    fact_transactions,
    rejected_of,
    silver_of,
    status_counts,
)
from ledgerproof.operators.report import Report, run_all
from ledgerproof.plans import oracle as O
from ledgerproof.plans.jobs import add_column, build_medallion, compact_table, publish_account_summary, run_control
from ledgerproof.schemas import BRONZE_COLUMNS
from ledgerproof.session import materialize_at, remove_path, scratch_path
from ledgerproof.sources.fixture import bronze_fixture, event_records
from ledgerproof.sources.landing import land_batch, path_layers, to_bronze
from ledgerproof.streaming.autoload import autoload_stream, read_dead_letter, read_stream_bronze

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries.
LAND_STAMP = datetime(2024, 2, 1, 0, 0, 0, tzinfo=UTC)
LAND_BATCH_ID = "batch-20240201000000"
LOOKUP_ACCOUNT = "ACC-00042"
ABS_TOLERANCE = 5000
REL_TOLERANCE = 0.001
#: Faults that the checks must find, by the number in an event's or account's id (SQL that both engines read).
EVENT_NUMBER = "CAST(substr(event_id, 5) AS BIGINT)"
LOST_ROW = f"{EVENT_NUMBER} % 251 = 9"
COPIED_ROW = f"{EVENT_NUMBER} % 211 = 4"
LOST_ACCOUNT = "CAST(substr(account_id, 5) AS BIGINT) % 7 = 2"
LOST_REASON = "missing_currency"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Medallion:
    """All layers of one fixture variant, built lazily from ``events``."""

    def __init__(self, spark: SparkSession, sf_dir: str, *, faulty: bool = True) -> None:
        self.events = table(spark, sf_dir, "events")
        self.bronze = bronze_fixture(self.events, faulty=faulty)
        self.deduped = dedup_bronze(self.bronze)
        self.classified = classify(self.deduped)
        self.silver = silver_of(self.classified)
        self.rejected = rejected_of(self.classified)
        self.fact = fact_transactions(self.silver)
        self.dim = dim_account(self.silver)
        self.fact_fault = fact_transactions(drop_fx_conversions(self.silver))

    def totals(self, layer: str) -> DataFrame:
        """Control totals of one layer, its distinct ids counted from its own rows."""
        frame, label = {
            "bronze_raw": (self.bronze, "bronze"), "bronze": (self.deduped, "bronze"), "silver": (self.silver, "silver"),
            "rejected": (self.rejected, "rejected"), "gold": (self.fact, "gold"), "gold_fault": (self.fact_fault, "gold"),
        }[layer]
        return control_totals(frame, label)


def _m(spark: SparkSession, sf_dir: str, faulty: bool = True) -> Medallion:
    return Medallion(spark, sf_dir, faulty=faulty)


# ---------------------------------------------------------------- landing, fixture, dedup


def q_land_batch(spark, sf_dir):
    records = event_records(table(spark, sf_dir, "events")).drop("_src")
    return land_batch(records, batch_id=LAND_BATCH_ID, ingested_at=LAND_STAMP)


def q_bronze_clean_projection(spark, sf_dir):
    return bronze_fixture(table(spark, sf_dir, "events"), faulty=False, keep_src=False)


def q_dedup_first_arrival(spark, sf_dir):
    return _m(spark, sf_dir).deduped.select(*BRONZE_COLUMNS)


LINEITEM_KEY = ("l_orderkey", "l_linenumber")
LINEITEM_ORDER = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


def q_dedup_lineitem(spark, sf_dir):
    return first_arrival(table(spark, sf_dir, "lineitem"), LINEITEM_KEY, LINEITEM_ORDER)


# ---------------------------------------------------------------- silver / gold


def q_silver_valid(spark, sf_dir):
    return _m(spark, sf_dir).silver


def q_silver_rejected(spark, sf_dir):
    return _m(spark, sf_dir).rejected


def q_status_counts(spark, sf_dir):
    return status_counts(_m(spark, sf_dir).classified)


def q_gold_fact(spark, sf_dir):
    return _m(spark, sf_dir).fact


def q_gold_fact_fault(spark, sf_dir):
    return _m(spark, sf_dir).fact_fault


def q_dim_account(spark, sf_dir):
    return _m(spark, sf_dir).dim


def q_account_lookup(spark, sf_dir):
    return account_lookup(_m(spark, sf_dir).dim, LOOKUP_ACCOUNT)


def q_account_list(spark, sf_dir):
    return account_summary(_m(spark, sf_dir).dim)


def q_amount_major(spark, sf_dir):
    s = _m(spark, sf_dir).silver
    return s.select("event_id", "signed_amount_minor", amount_major("signed_amount_minor").alias("amount_major"))


# ---------------------------------------------------------------- control totals


def q_totals_bronze_deduped(spark, sf_dir):
    return _m(spark, sf_dir).totals("bronze")


def q_totals_silver(spark, sf_dir):
    return _m(spark, sf_dir).totals("silver")


def q_totals_gold(spark, sf_dir):
    return _m(spark, sf_dir).totals("gold")


def q_totals_rejected(spark, sf_dir):
    return _m(spark, sf_dir).totals("rejected")


def q_source_manifest(spark, sf_dir):
    return source_manifest(_m(spark, sf_dir, faulty=False).bronze)


def q_source_manifest_totals(spark, sf_dir):
    return manifest_totals(_m(spark, sf_dir, faulty=False).bronze)


def _all_layer_totals(m: Medallion) -> DataFrame:
    return m.totals("bronze").unionByName(m.totals("silver")).unionByName(m.totals("gold")).unionByName(m.totals("rejected"))


def q_totals_invariants(spark, sf_dir):
    return invariant_violations(_all_layer_totals(_m(spark, sf_dir)))


def q_totals_duplicate_keys(spark, sf_dir):
    return duplicate_keys(_all_layer_totals(_m(spark, sf_dir)))


def external_totals(m: Medallion) -> DataFrame:
    """Totals as another system might send them, broken: dates with an odd row count claim more distinct ids than
    rows, dates before the 5th of a month a negative count, and dates of the 17th come twice."""
    t = m.totals("silver")
    odd = (F.col("row_count") % 2 == 1)
    early = F.substring("partition_key", 9, 2) < "05"
    sent = t.withColumn("distinct_event_ids", F.when(odd, F.col("row_count") + 1).otherwise(F.col("distinct_event_ids")))
    sent = sent.withColumn("row_count", F.when(early, -F.col("row_count")).otherwise(F.col("row_count")))
    return sent.unionByName(sent.filter(F.col("partition_key").endswith("17")))


def q_totals_invariants_broken(spark, sf_dir):
    return invariant_violations(external_totals(_m(spark, sf_dir)))


def q_totals_duplicate_keys_broken(spark, sf_dir):
    return duplicate_keys(external_totals(_m(spark, sf_dir)))


def order_totals(orders: DataFrame) -> DataFrame:
    return control_totals(
        orders.withColumn("_amount", minor_units("o_totalprice")).withColumn("_date", F.to_date("o_orderdate")),
        "orders",
        partition_col="_date",
        amount_column="_amount",
        key_column="o_orderkey",
    )


def lineitem_totals_by_order_date(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Lineitems by their order's date. Lines are pre-aggregated per order before the join, so the join
    moves one row per order (the aggregate's hash partitioning on the key is reused by the join)."""
    per_order = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("_lines"),
        F.sum(minor_units("l_extendedprice")).alias("_amount"),
    )
    # lines whose order is missing stay, under 'None': the totals exist to find such rows
    dated = per_order.join(orders.select("o_orderkey", "o_orderdate"), "o_orderkey", "left")
    return dated.groupBy(
        F.coalesce(F.to_date("o_orderdate").cast("string"), F.lit("None")).alias("partition_key")
    ).agg(
        F.sum("_lines").cast("bigint").alias("row_count"),
        F.coalesce(F.sum("_amount"), F.lit(0)).cast("bigint").alias("amount_minor_sum"),
        F.count(F.lit(1)).alias("distinct_event_ids"),
    ).select(F.lit("lineitem").alias("layer"), "partition_key", "row_count", "amount_minor_sum", "distinct_event_ids")


def q_totals_orders_vs_lineitem(spark, sf_dir):
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return order_totals(orders).unionByName(lineitem_totals_by_order_date(lineitem, orders))


def q_check_orders_vs_lineitem(spark, sf_dir):
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return C.row_count_check(
        order_totals(orders), lineitem_totals_by_order_date(lineitem, orders),
        source_layer="orders", target_layer="lineitem", expect_distinct_target=True,
    ).breaks


# ---------------------------------------------------------------- checks


def q_check_row_count_bronze_silver(spark, sf_dir):
    m = _m(spark, sf_dir)
    return C.row_count_check(m.totals("bronze"), m.totals("silver")).breaks


def q_check_row_count_silver_gold(spark, sf_dir):
    m = _m(spark, sf_dir)
    return C.row_count_check(m.totals("silver"), m.totals("gold_fault"), source_layer="silver", target_layer="gold").breaks


def q_check_row_count_distinct_modes(spark, sf_dir):
    source = source_manifest(_m(spark, sf_dir, faulty=False).bronze)
    bronze_raw = control_totals(_m(spark, sf_dir).bronze, "bronze", partition_col="event_date")
    return C.row_count_check(
        source, bronze_raw, source_layer="source", target_layer="bronze", expect_distinct_target=True
    ).breaks


def _amount(spark, sf_dir, **tol):
    m = _m(spark, sf_dir)
    return C.amount_sum_check(m.totals("bronze"), m.totals("silver"), **tol).breaks


def q_check_amount_exact(spark, sf_dir):
    return _amount(spark, sf_dir)


def q_check_amount_abs_tol(spark, sf_dir):
    return _amount(spark, sf_dir, tolerance_minor=ABS_TOLERANCE)


def q_check_amount_rel_tol(spark, sf_dir):
    return _amount(spark, sf_dir, relative_tolerance=REL_TOLERANCE)


def q_check_dedup_bronze(spark, sf_dir):
    return C.dedup_check(_m(spark, sf_dir).totals("bronze_raw"), layer="bronze").breaks


def q_check_dedup_silver(spark, sf_dir):
    return C.dedup_check(_m(spark, sf_dir).totals("silver")).breaks


def q_check_dedup_silver_copies(spark, sf_dir):
    silver = _m(spark, sf_dir).silver
    return C.dedup_check(control_totals(silver.unionByName(silver.filter(COPIED_ROW)), "silver")).breaks


def q_check_ref_integrity_ok(spark, sf_dir):
    m = _m(spark, sf_dir)
    return C.referential_integrity_check(m.fact, m.dim).breaks


def q_check_ref_integrity_lost_accounts(spark, sf_dir):
    m = _m(spark, sf_dir)
    return C.referential_integrity_check(m.fact, m.dim.filter(f"NOT ({LOST_ACCOUNT})")).breaks


def _orphans(spark, sf_dir, dimension: str, column: str, severity: str = "error", with_null: bool = False):
    """Customers that a table never names: natural orphans, over whole tables."""
    fact = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    dim = table(spark, sf_dir, dimension).select(F.col(column).alias("k"))
    if with_null:
        null_row = spark.range(1).select(F.lit(None).cast("bigint").alias("k"))
        fact, dim = fact.unionByName(null_row), dim.unionByName(null_row)
    return C.referential_integrity_check(fact, dim, key="k", dimension_name=dimension, severity=severity).breaks


def q_check_ref_integrity_orphans(spark, sf_dir):
    return _orphans(spark, sf_dir, "events", "user_id")


def q_check_ref_integrity_warning(spark, sf_dir):
    return _orphans(spark, sf_dir, "events", "user_id", severity="warning")


def q_check_ref_integrity_null_key(spark, sf_dir):
    return _orphans(spark, sf_dir, "events", "user_id", with_null=True)


def _conservation(spark, sf_dir, measure: str, *, lost_silver: bool = False, lost_quarantine: bool = False):
    m = _m(spark, sf_dir)
    silver = m.silver.filter(f"NOT ({LOST_ROW})") if lost_silver else m.silver
    rejected = m.rejected.filter(F.col("rejection_reason") != LOST_REASON) if lost_quarantine else m.rejected
    return C.conservation_check(m.totals("bronze"), control_totals(silver, "silver"), control_totals(rejected, "rejected"),
                                measure=measure).breaks


def q_check_conservation(spark, sf_dir):
    return _conservation(spark, sf_dir, "rows")


def q_check_conservation_amount(spark, sf_dir):
    return _conservation(spark, sf_dir, "amount")


def q_check_conservation_lost_silver(spark, sf_dir):
    return _conservation(spark, sf_dir, "rows", lost_silver=True)


def q_check_conservation_lost_quarantine(spark, sf_dir):
    return _conservation(spark, sf_dir, "amount", lost_quarantine=True)


# ---------------------------------------------------------------- suites over written layers


def _fresh_dir(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, f"ledgerproof-{label}-{uuid.uuid4().hex[:12]}")


def _settled(spark: SparkSession, result: DataFrame, *used: str) -> DataFrame:
    """``result`` written by itself, so that the folders it was made from can go."""
    kept, _ = materialize_at(result, "result")
    for path in used:
        remove_path(spark, path)
    return kept


def written_layers(spark: SparkSession, sf_dir: str, **build) -> tuple[dict[str, str], str]:
    """The faulty fixture landed as a date-partitioned bronze table, and the build job run on it."""
    root = _fresh_dir(spark, "build")
    layers = path_layers(root)
    bronze_fixture(table(spark, sf_dir, "events"), faulty=True, keep_src=False).write.partitionBy("event_date").parquet(
        layers["bronze"])
    build_medallion(spark, layers, **build)
    return layers, root


def _suite(spark, sf_dir, take: Callable[[Report], DataFrame], *, fault: bool = False, mode: str = "parity",
           damage: Callable[[SparkSession, dict[str, str]], None] | None = None, source: DataFrame | None = None):
    """What ``take`` makes of the control job's report over written layers, ``damage`` done to them in between."""
    layers, root = written_layers(spark, sf_dir, inject_break=fault)
    if damage:
        damage(spark, layers)
    report = run_control(spark, layers, mode=mode, raise_on_error=False, source=source)
    return _settled(spark, take(report), root, *report.scratch)


def _rewritten(spark: SparkSession, path: str, column: str, change: Callable[[DataFrame], DataFrame]) -> None:
    staged, scratch = materialize_at(spark.read.parquet(path), "damage")
    change(staged).write.mode("overwrite").partitionBy(column).parquet(path)
    remove_path(spark, scratch)


def damaged_silver(spark: SparkSession, layers: dict[str, str]) -> None:
    """Silver after the build: some rows lost, some twice."""
    _rewritten(spark, layers["silver"], "business_date",
               lambda df: df.filter(f"NOT ({LOST_ROW})").unionByName(df.filter(COPIED_ROW)))


def q_reconcile_suite_breaks(spark, sf_dir):
    return _suite(spark, sf_dir, lambda r: r.breaks)


def q_reconcile_suite_summary(spark, sf_dir):
    return _suite(spark, sf_dir, lambda r: r.summary)


def q_reconcile_suite_fault_breaks(spark, sf_dir):
    return _suite(spark, sf_dir, lambda r: r.breaks, fault=True)


def q_reconcile_suite_fault_summary(spark, sf_dir):
    return _suite(spark, sf_dir, lambda r: r.summary, fault=True)


def q_reconcile_suite_damaged_summary(spark, sf_dir):
    return _suite(spark, sf_dir, lambda r: r.summary, damage=damaged_silver)


def q_reconcile_suite_damaged_breaks(spark, sf_dir):
    return _suite(spark, sf_dir, lambda r: r.breaks, damage=damaged_silver, mode="conservation")


def q_reconcile_conservation_summary(spark, sf_dir):
    return _suite(spark, sf_dir, lambda r: r.summary, mode="conservation")


def q_break_descriptions(spark, sf_dir):
    return _suite(spark, sf_dir, lambda r: r.break_descriptions(), fault=True)


def q_report_lines(spark, sf_dir):
    """The report's whole text, a row per line."""
    return _suite(spark, sf_dir, lambda r: r.lines().select("line"), fault=True)


def q_report_records(spark, sf_dir):
    """The machine-readable report, whole."""
    return _suite(spark, sf_dir, lambda r: r.records(), fault=True)


def q_reconcile_checks(spark, sf_dir):
    """Several checks on one pair of totals as one report (row count and amount, bronze -> silver)."""
    m = _m(spark, sf_dir)
    b, s = m.totals("bronze"), m.totals("silver")
    return run_all([C.row_count_check(b, s), C.amount_sum_check(b, s)]).summary


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)
}


# ---------------------------------------------------------------- oracle SQL


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


FAULTY = O.fixture_ctes(True)
CLEAN = O.fixture_ctes(False, prefix="c_")
T_BRONZE = f"bt AS ({O.totals_sql('dedup', 'bronze')})"
T_SILVER = f"st AS ({O.totals_sql('silver', 'silver')})"
T_GOLD = f"gt AS ({O.totals_sql('gold', 'gold')})"
T_GOLD_FAULT = f"gft AS ({O.totals_sql('gold_fault', 'gold')})"
T_REJECTED = f"rt AS ({O.totals_sql('rejected', 'rejected')})"
T_BRONZE_RAW = f"brt AS ({O.totals_sql('bronze', 'bronze')})"
LAND_TS = "TIMESTAMP '2024-02-01 00:00:00'"
ORDER_TOTALS = """ot AS (
  SELECT 'orders' AS layer, coalesce(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 'None') AS partition_key,
    count(*) AS row_count, CAST(coalesce(sum(CAST(round(o_totalprice * 100) AS BIGINT)), 0) AS BIGINT) AS amount_minor_sum,
    count(DISTINCT o_orderkey) AS distinct_event_ids
  FROM orders GROUP BY 2)"""
LINE_TOTALS = """lt AS (
  SELECT 'lineitem' AS layer, coalesce(CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR), 'None') AS partition_key,
    count(*) AS row_count, CAST(coalesce(sum(CAST(round(l.l_extendedprice * 100) AS BIGINT)), 0) AS BIGINT) AS amount_minor_sum,
    count(DISTINCT l.l_orderkey) AS distinct_event_ids
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 2)"""
CONS_TARGET = """srt AS (
  SELECT partition_key, CAST(sum(row_count) AS BIGINT) AS row_count,
         CAST(sum(amount_minor_sum) AS BIGINT) AS amount_minor_sum,
         CAST(sum(distinct_event_ids) AS BIGINT) AS distinct_event_ids
  FROM (SELECT * FROM st UNION ALL SELECT * FROM rt) u GROUP BY partition_key)"""


EXTERNAL_TOTALS = """sent AS (
  SELECT layer, partition_key,
    CASE WHEN substr(partition_key, 9, 2) < '05' THEN -row_count ELSE row_count END AS row_count, amount_minor_sum,
    CASE WHEN row_count % 2 = 1 THEN row_count + 1 ELSE distinct_event_ids END AS distinct_event_ids FROM st),
ext AS (SELECT * FROM sent UNION ALL SELECT * FROM sent WHERE partition_key LIKE '%17')"""


def _conservation_sql(measure: str, every: bool = False) -> str:
    col = "row_count" if measure == "rows" else "amount_minor_sum"
    check = "conservation" if measure == "rows" else "conservation_amount"
    return f"""SELECT '{check}' AS "check", coalesce(s.partition_key, t.partition_key) AS partition_key,
    'bronze' AS source_layer, 'silver+rejected' AS target_layer,
    CAST(coalesce(s.{col}, 0) AS BIGINT) AS expected, CAST(coalesce(t.{col}, 0) AS BIGINT) AS actual,
    CAST(coalesce(t.{col}, 0) - coalesce(s.{col}, 0) AS BIGINT) AS delta, 'error' AS severity,
    'rows neither in the target layer nor in quarantine' AS note
  FROM bt s FULL OUTER JOIN srt t ON s.partition_key = t.partition_key
  {"" if every else f"WHERE coalesce(s.{col}, 0) <> coalesce(t.{col}, 0)"}"""


def _suite_evaluated(gold: str, dim: str) -> list[tuple[str, str, str, str]]:
    """(evaluated SQL, check, source layer, target layer) in suite order."""
    return [
        (O.row_check_sql("bt", "st", "bronze", "silver", evaluated=True), "row_count", "bronze", "silver"),
        (O.amount_check_sql("bt", "st", "bronze", "silver", evaluated=True), "amount_sum", "bronze", "silver"),
        (O.row_check_sql("st", gold, "silver", "gold", evaluated=True), "row_count", "silver", "gold"),
        (O.amount_check_sql("st", gold, "silver", "gold", evaluated=True), "amount_sum", "silver", "gold"),
        (O.dedup_check_sql("st", evaluated=True), "deduplication", "silver", "silver"),
        (
            O.integrity_sql(
                f"(SELECT account_id AS k FROM {'gold_fault' if gold == 'gft' else 'gold'})",
                f"(SELECT account_id AS k FROM {dim})",
                dimension="dim_account",
                evaluated=True,
            ),
            "referential_integrity", "gold", "gold",
        ),
    ]


def _suite_breaks_sql(fault: bool) -> str:
    gold, dim = ("gft", "dim_fault") if fault else ("gt", "dim")
    parts = [f"SELECT * EXCLUDE (is_break) FROM ({sql}) e WHERE is_break" for sql, *_ in _suite_evaluated(gold, dim)]
    return _with(FAULTY, T_BRONZE, T_SILVER, T_GOLD, T_GOLD_FAULT) + "\nUNION ALL\n".join(parts)


def _suite_summary_sql(fault: bool) -> str:
    gold, dim = ("gft", "dim_fault") if fault else ("gt", "dim")
    parts = [O.summary_sql(sql, i + 1, *rest) for i, (sql, *rest) in enumerate(_suite_evaluated(gold, dim))]
    return _with(FAULTY, T_BRONZE, T_SILVER, T_GOLD, T_GOLD_FAULT) + "\nUNION ALL\n".join(parts)


T_DAMAGED = (f"damaged AS (SELECT * FROM silver WHERE NOT ({LOST_ROW}) UNION ALL SELECT * FROM silver WHERE {COPIED_ROW}),\n"
             f"st AS ({O.totals_sql('damaged', 'silver')})")


def _conservation_evaluated() -> list[tuple[str, str, str, str]]:
    """The suite in conservation mode: (evaluated SQL, check, source layer, target layer)."""
    cons = [(f"SELECT *, coalesce(expected, 0) <> coalesce(actual, 0) AS is_break FROM ({_conservation_sql(m, every=True)}) c",
             check, "bronze", "silver+rejected")
            for m, check in (("rows", "conservation"), ("amount", "conservation_amount"))]
    return cons + _suite_evaluated("gt", "dim")[2:]


def _breaks_of(evaluated: list[tuple[str, str, str, str]]) -> str:
    return "\nUNION ALL\n".join(f"SELECT * EXCLUDE (is_break) FROM ({sql}) e WHERE is_break" for sql, *_ in evaluated)


def _summaries_of(evaluated: list[tuple[str, str, str, str]]) -> str:
    return "\nUNION ALL\n".join(O.summary_sql(sql, i + 1, *rest) for i, (sql, *rest) in enumerate(evaluated))


def _conservation_summary_sql() -> str:
    return _with(FAULTY, T_BRONZE, T_SILVER, T_GOLD, T_REJECTED, CONS_TARGET) + _summaries_of(_conservation_evaluated())


def _orphans_sql(dimension: str, column: str, severity: str = "error", with_null: bool = False) -> str:
    null = " UNION ALL SELECT NULL" if with_null else ""
    return O.integrity_sql(f"(SELECT c_custkey AS k FROM customer{null})", f"(SELECT {column} AS k FROM {dimension}{null})",
                           dimension=dimension, severity=severity)


def _records_sql() -> str:
    evaluated = _suite_evaluated("gft", "dim_fault")
    checks = f"""SELECT 'check' AS record, *, NULL AS partition_key, NULL AS expected, NULL AS actual, NULL AS delta,
    NULL AS severity, NULL AS note FROM ({_summaries_of(evaluated)}) c"""
    breaks = "\nUNION ALL\n".join(f"""SELECT 'break', {i + 1}, "check", source_layer, target_layer, NULL, NULL, NULL, partition_key,
    expected, actual, delta, severity, note FROM ({sql}) e WHERE is_break""" for i, (sql, *_) in enumerate(evaluated))
    return f"{checks}\nUNION ALL\n{breaks}"


_DESCRIPTION = """printf('[%s] %s @ %s: %s=%d vs %s=%d (delta %+d)%s', upper(severity), "check", partition_key,
    source_layer, expected, target_layer, actual, delta,
    CASE WHEN coalesce(note, '') = '' THEN '' ELSE concat(' (', note, ')') END) AS description"""

ORACLE: dict[str, str] = {
    "land_batch": _with(f"base AS ({O.base_events(False)})")
    + f"""SELECT event_id, account_id, amount_minor,
    CASE WHEN direction = 'debit' THEN -abs(amount_minor) ELSE abs(amount_minor) END AS signed_amount_minor,
    currency, direction, transaction_type, occurred_at, CAST(occurred_at AS DATE) AS event_date, source_system,
    {LAND_TS} AS ingested_at, '{LAND_BATCH_ID}' AS batch_id FROM base""",
    "bronze_clean_projection": _with(CLEAN) + f"SELECT {O.BRONZE_COLS} FROM c_bronze",
    "dedup_first_arrival": _with(FAULTY) + f"SELECT {O.BRONZE_COLS} FROM dedup",
    "dedup_lineitem": f"""SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
    {', '.join(c + ' ASC NULLS LAST' for c in LINEITEM_ORDER)}) AS _rn
  FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL) r WHERE _rn = 1
UNION ALL
SELECT * FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL""",
    "silver_valid": _with(FAULTY) + "SELECT * FROM silver",
    "silver_rejected": _with(FAULTY) + "SELECT * FROM rejected",
    "status_counts": _with(FAULTY)
    + "SELECT coalesce(rejection_reason, 'valid') AS status, count(*) AS row_count FROM classified GROUP BY 1",
    "gold_fact": _with(FAULTY) + "SELECT * FROM gold",
    "gold_fact_fault": _with(FAULTY) + "SELECT * FROM gold_fault",
    "dim_account": _with(FAULTY) + "SELECT * FROM dim",
    "account_lookup": _with(FAULTY)
    + f"SELECT account_id, transaction_count, net_amount_minor FROM dim WHERE account_id = '{LOOKUP_ACCOUNT}'",
    "account_list": _with(FAULTY) + "SELECT account_id, transaction_count, net_amount_minor FROM dim",
    "amount_major": _with(FAULTY)
    + """SELECT event_id, signed_amount_minor,
    CAST(CAST(signed_amount_minor AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(22,2)) AS amount_major
  FROM silver""",
    "totals_bronze_deduped": _with(FAULTY) + O.totals_sql("dedup", "bronze"),
    "totals_silver": _with(FAULTY) + O.totals_sql("silver", "silver"),
    "totals_gold": _with(FAULTY) + O.totals_sql("gold", "gold"),
    "totals_rejected": _with(FAULTY) + O.totals_sql("rejected", "rejected"),
    "source_manifest": _with(CLEAN) + O.totals_sql("c_dedup", "source", date_expr="event_date"),
    "source_manifest_totals": _with(CLEAN)
    + "SELECT count(DISTINCT event_id) AS unique_events, count(*) - count(DISTINCT event_id) AS duplicates FROM c_bronze",
    "totals_invariants": _with(FAULTY, T_BRONZE, T_SILVER, T_GOLD, T_REJECTED)
    + """SELECT *, CASE WHEN row_count < 0 OR distinct_event_ids < 0 THEN 'negative count'
    ELSE 'distinct exceeds rows' END AS violation
  FROM (SELECT * FROM bt UNION ALL SELECT * FROM st UNION ALL SELECT * FROM gt UNION ALL SELECT * FROM rt) u
  WHERE row_count < 0 OR distinct_event_ids < 0 OR distinct_event_ids > row_count""",
    "totals_duplicate_keys": _with(FAULTY, T_BRONZE, T_SILVER, T_GOLD, T_REJECTED)
    + """SELECT layer, partition_key, count(*) AS occurrences
  FROM (SELECT * FROM bt UNION ALL SELECT * FROM st UNION ALL SELECT * FROM gt UNION ALL SELECT * FROM rt) u
  GROUP BY layer, partition_key HAVING count(*) > 1""",
    "totals_orders_vs_lineitem": _with(ORDER_TOTALS, LINE_TOTALS) + "SELECT * FROM ot UNION ALL SELECT * FROM lt",
    "check_orders_vs_lineitem": _with(ORDER_TOTALS, LINE_TOTALS)
    + O.row_check_sql("ot", "lt", "orders", "lineitem", distinct_target=True),
    "check_row_count_bronze_silver": _with(FAULTY, T_BRONZE, T_SILVER) + O.row_check_sql("bt", "st", "bronze", "silver"),
    "check_row_count_silver_gold": _with(FAULTY, T_SILVER, T_GOLD_FAULT) + O.row_check_sql("st", "gft", "silver", "gold"),
    "check_row_count_distinct_modes": _with(
        FAULTY, CLEAN, f"mt AS ({O.totals_sql('c_dedup', 'source', date_expr='event_date')})",
        f"brt AS ({O.totals_sql('bronze', 'bronze', date_expr='event_date')})",
    )
    + O.row_check_sql("mt", "brt", "source", "bronze", distinct_target=True),
    "check_amount_exact": _with(FAULTY, T_BRONZE, T_SILVER) + O.amount_check_sql("bt", "st", "bronze", "silver"),
    "check_amount_abs_tol": _with(FAULTY, T_BRONZE, T_SILVER)
    + O.amount_check_sql("bt", "st", "bronze", "silver", tolerance=ABS_TOLERANCE),
    "check_amount_rel_tol": _with(FAULTY, T_BRONZE, T_SILVER)
    + O.amount_check_sql("bt", "st", "bronze", "silver", relative=REL_TOLERANCE),
    "check_dedup_bronze": _with(FAULTY, T_BRONZE_RAW) + O.dedup_check_sql("brt"),
    "check_dedup_silver": _with(FAULTY, T_SILVER) + O.dedup_check_sql("st"),
    "check_ref_integrity_ok": _with(FAULTY)
    + O.integrity_sql("(SELECT account_id AS k FROM gold)", "(SELECT account_id AS k FROM dim)", dimension="dim_account"),
    "check_ref_integrity_lost_accounts": _with(FAULTY)
    + O.integrity_sql("(SELECT account_id AS k FROM gold)", f"(SELECT account_id AS k FROM dim WHERE NOT ({LOST_ACCOUNT}))",
                      dimension="dim_account"),
    "check_ref_integrity_orphans": _orphans_sql("events", "user_id"),
    "check_ref_integrity_warning": _orphans_sql("events", "user_id", "warning"),
    "check_ref_integrity_null_key": _orphans_sql("events", "user_id", with_null=True),
    "check_dedup_silver_copies": _with(FAULTY, f"copies AS (SELECT * FROM silver UNION ALL SELECT * FROM silver WHERE {COPIED_ROW})",
                                       f"st AS ({O.totals_sql('copies', 'silver')})") + O.dedup_check_sql("st"),
    "check_conservation_lost_silver": _with(FAULTY, T_BRONZE, f"less AS (SELECT * FROM silver WHERE NOT ({LOST_ROW}))",
                                            f"st AS ({O.totals_sql('less', 'silver')})", T_REJECTED, CONS_TARGET)
    + _conservation_sql("rows"),
    "check_conservation_lost_quarantine": _with(
        FAULTY, T_BRONZE, T_SILVER, f"less AS (SELECT * FROM rejected WHERE rejection_reason <> '{LOST_REASON}')",
        f"rt AS ({O.totals_sql('less', 'rejected')})", CONS_TARGET) + _conservation_sql("amount"),
    "totals_invariants_broken": _with(FAULTY, T_SILVER, EXTERNAL_TOTALS)
    + """SELECT *, CASE WHEN row_count < 0 OR distinct_event_ids < 0 THEN 'negative count' ELSE 'distinct exceeds rows' END
      AS violation FROM ext WHERE row_count < 0 OR distinct_event_ids < 0 OR distinct_event_ids > row_count""",
    "totals_duplicate_keys_broken": _with(FAULTY, T_SILVER, EXTERNAL_TOTALS)
    + "SELECT layer, partition_key, count(*) AS occurrences FROM ext GROUP BY layer, partition_key HAVING count(*) > 1",
    "check_conservation": _with(FAULTY, T_BRONZE, T_SILVER, T_REJECTED, CONS_TARGET) + _conservation_sql("rows"),
    "check_conservation_amount": _with(FAULTY, T_BRONZE, T_SILVER, T_REJECTED, CONS_TARGET)
    + _conservation_sql("amount"),
    "reconcile_suite_breaks": _suite_breaks_sql(False),
    "reconcile_suite_summary": _suite_summary_sql(False),
    "reconcile_suite_fault_breaks": _suite_breaks_sql(True),
    "reconcile_suite_fault_summary": _suite_summary_sql(True),
    "reconcile_suite_damaged_summary": _with(FAULTY, T_BRONZE, T_DAMAGED, T_GOLD) + _summaries_of(_suite_evaluated("gt", "dim")),
    "reconcile_suite_damaged_breaks": _with(FAULTY, T_BRONZE, T_DAMAGED, T_GOLD, T_REJECTED, CONS_TARGET)
    + _breaks_of(_conservation_evaluated()),
    "report_lines": _with(FAULTY, T_BRONZE, T_SILVER, T_GOLD_FAULT, f"b AS ({_breaks_of(_suite_evaluated('gft', 'dim_fault'))})")
    + f"""SELECT printf('reconciliation FAILED: %d error(s), %d warning(s)', count(*) FILTER (WHERE severity = 'error'),
    count(*) FILTER (WHERE severity = 'warning')) AS line FROM b
  UNION ALL SELECT concat('  ', description) FROM (SELECT {_DESCRIPTION} FROM b) d""",
    "report_records": _with(FAULTY, T_BRONZE, T_SILVER, T_GOLD_FAULT) + _records_sql(),
    "reconcile_conservation_summary": _conservation_summary_sql(),
    "break_descriptions": f"SELECT *, {_DESCRIPTION} FROM (" + _suite_breaks_sql(True) + ") b",
    "reconcile_checks": _with(FAULTY, T_BRONZE, T_SILVER)
    + "\nUNION ALL\n".join(
        [
            O.summary_sql(O.row_check_sql("bt", "st", "bronze", "silver", evaluated=True), 1, "row_count", "bronze", "silver"),
            O.summary_sql(
                O.amount_check_sql("bt", "st", "bronze", "silver", evaluated=True), 2, "amount_sum", "bronze", "silver"
            ),
        ]
    ),
}


# ---------------------------------------------------------------- JSON lines (validation, dead letter)

_GOOD_EVENT = {
    "event_id": "EVT-90000000",
    "account_id": "ACC-00001",
    "amount_minor": 100,
    "currency": "GBP",
    "direction": "credit",
    "transaction_type": "fee",
    "occurred_at": "2026-09-01T12:00:00Z",
    "source_system": "core-ledger",
}


def _variant(n: int, **changes: object) -> str:
    import json

    return json.dumps({**_GOOD_EVENT, "event_id": f"EVT-9{n:07d}", **changes})


# Hand-written lines appended to the event-derived lines (one per edge case).
HAND_LINES = (
    ("hand-01", "{not json"),
    ("hand-02", "[1, 2, 3]"),
    ("hand-03", "null"),
    ("hand-04", _variant(4, event_id=12345678)),
    ("hand-05", _variant(5, amount_minor="100")),
    ("hand-06", _variant(6, amount_minor=100.0)),
    ("hand-07", _variant(7, amount_minor=100.5)),
    ("hand-08", _variant(8, amount_minor=0)),
    ("hand-09", _variant(9, currency="POUNDS")),
    ("hand-10", _variant(10, currency="\tgbp ")),
    ("hand-11", _variant(11, direction="sideways")),
    ("hand-12", _variant(12, occurred_at="2026-09-01T12:00:00")),
    ("hand-13", _variant(13, occurred_at="2026-09-01T23:30:00-05:00")),
    ("hand-14", _variant(14, event_id="EVT-123")),
    ("hand-15", _variant(15) + _variant(16)),
    ("hand-16", _variant(17) + " garbage"),
    ("hand-17", _variant(18).replace('"', "'")),
    ("hand-18", _variant(19).replace("100", "100.0000001")),
    ("hand-19", _variant(20, amount_minor="1e2")),
    ("hand-20", "\t" + _variant(21) + " "),
    ("hand-21", _variant(22, amount_minor=True)),
    ("hand-22", _variant(23, occurred_at="2026-09-01")),
    ("hand-23", _variant(24, occurred_at=1788264000)),
    ("hand-24", _variant(25, occurred_at="1788264000")),
    ("hand-25", _variant(26, occurred_at="2026-09-01t12:00:00Z")),
    ("hand-26", _variant(27) + "], [" + _variant(28)),
    ("hand-27", _variant(29) + ', "b": 1'),
    ("hand-28", _variant(30, amount_minor=False)),
    ("hand-29", _variant(31, amount_minor="1_000")),
    ("hand-30", _variant(32, occurred_at=1788264000123)),
    ("hand-31", _variant(33, amount_minor=2**63)),
    ("hand-32", _variant(34, occurred_at="2026-09-01T12:00Z")),
    ("hand-33", _variant(35, occurred_at="2026-09-01_12:00:00Z")),
    ("hand-34", _variant(36, occurred_at="2026-09-01 12:00:00,25+05:30")),
    ("hand-35", _variant(37, occurred_at="2026-09-01T12:00:00+02")),
    ("hand-36", _variant(38, occurred_at="2026-09-01T24:00:00Z")),
    ("hand-37", _variant(39, currency="\u00a0gbp\u00a0")),
    ("hand-38", _variant(40, extra={"nested": [1, {"deep": "}"}]})),
    ("hand-39", _variant(41, extra={}) + "}"),
    ("hand-40", _variant(42, occurred_at="2026-02-30")),
)


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(line_id, raw)``: one JSON line per clean event, plus the hand-written edge cases."""
    from ledgerproof.sources.json_lines import event_json

    records = event_records(table(spark, sf_dir, "events"))
    derived = records.select(
        F.concat(F.lit("evt-"), F.col("_src").cast("string")).alias("line_id"), event_json(records).alias("raw")
    )
    return derived.unionByName(spark.createDataFrame(list(HAND_LINES), "line_id string, raw string"))


def q_validate_json(spark, sf_dir):
    from ledgerproof.sources.json_lines import split_event_lines

    valid, _ = split_event_lines(event_lines(spark, sf_dir), keep=("line_id",))
    return valid


def q_dead_letter(spark, sf_dir):
    from ledgerproof.sources.json_lines import split_event_lines

    _, dead = split_event_lines(event_lines(spark, sf_dir), keep=("line_id",))
    return dead.select("line_id", "raw", F.array_join("failed_rules", ",").alias("failed_rules"))


def q_typed_json_read(spark, sf_dir):
    """Event files written as JSON lines and read with the declared schema."""
    from ledgerproof.functions.time import utc_wall_clock
    from ledgerproof.sources.json_lines import event_json, read_events_json

    path = _fresh_dir(spark, "json")
    records = event_records(table(spark, sf_dir, "events"))
    records.select(event_json(records)).write.text(path)
    return _settled(spark, read_events_json(spark, path).withColumn("occurred_at", utc_wall_clock("occurred_at")), path)


def _sql_literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_ISO = r"^(\d{4}-\d{2}-\d{2})[Tt _]((?:[01]\d|2[0-3]):\d{2}(?::\d{2}(?:[.,]\d{1,6})?)?)(Z|z|[+-]\d{2}:?\d{2})?$"
LINES_CTE = (
    CLEAN
    + """,
lines AS (
  SELECT concat('evt-', CAST(_src AS VARCHAR)) AS line_id,
    printf('{"event_id":"%s","account_id":"%s","amount_minor":%d,"currency":"%s","direction":"%s","transaction_type":"%s","occurred_at":"%s","source_system":"%s"}',
      event_id, account_id, amount_minor, currency, direction, transaction_type,
      strftime(occurred_at, '%Y-%m-%dT%H:%M:%S.%fZ'), source_system) AS raw
  FROM c_base
  UNION ALL
  SELECT * FROM (VALUES """
    + ", ".join(f"({_sql_literal(i)}, {_sql_literal(r)})" for i, r in HAND_LINES)
    + f""") v(line_id, raw)
),
j AS (SELECT line_id, raw, CASE WHEN json_valid(raw) AND json_type(raw) = 'OBJECT' THEN raw END AS doc FROM lines),
f AS (
  SELECT line_id, raw, doc,
    CASE WHEN json_type(doc, '$.event_id') = 'VARCHAR' THEN json_extract_string(doc, '$.event_id') END AS event_id,
    CASE WHEN json_type(doc, '$.account_id') = 'VARCHAR' THEN json_extract_string(doc, '$.account_id') END AS account_id,
    CASE json_type(doc, '$.amount_minor')
      WHEN 'BOOLEAN' THEN CASE WHEN json_extract_string(doc, '$.amount_minor') = 'true' THEN 1 ELSE 0 END
      WHEN 'DOUBLE' THEN CASE WHEN CAST(json_extract_string(doc, '$.amount_minor') AS DOUBLE)
                                   = floor(CAST(json_extract_string(doc, '$.amount_minor') AS DOUBLE))
                              THEN TRY_CAST(CAST(json_extract_string(doc, '$.amount_minor') AS DOUBLE) AS BIGINT) END
      WHEN 'VARCHAR' THEN CASE WHEN regexp_full_match(json_extract_string(doc, '$.amount_minor'), '\\s*[+-]?\\d+(_\\d+)*(\\.0+)?\\s*')
                               THEN TRY_CAST(regexp_replace(regexp_replace(json_extract_string(doc, '$.amount_minor'),
                                      '(\\.0+)?\\s*$', ''), '[\\s_]', '', 'g') AS BIGINT) END
      ELSE CASE WHEN json_type(doc, '$.amount_minor') IN ('BIGINT', 'UBIGINT')
                THEN TRY_CAST(json_extract_string(doc, '$.amount_minor') AS BIGINT) END END AS amount_dec,
    CASE WHEN json_type(doc, '$.currency') = 'VARCHAR'
         THEN upper(regexp_replace(json_extract_string(doc, '$.currency'), '^[\\s\\x{{00a0}}]+|[\\s\\x{{00a0}}]+$', '', 'g')) END AS currency,
    CASE WHEN json_type(doc, '$.direction') = 'VARCHAR' THEN json_extract_string(doc, '$.direction') END AS direction,
    CASE WHEN json_type(doc, '$.transaction_type') = 'VARCHAR' THEN json_extract_string(doc, '$.transaction_type') END
      AS transaction_type,
    CASE WHEN json_type(doc, '$.occurred_at') = 'VARCHAR' THEN regexp_replace(json_extract_string(doc, '$.occurred_at'),
         '^(\\d{{4}}-\\d{{2}}-\\d{{2}})$', '\\1 00:00:00') END AS ts_text,
    CASE WHEN json_type(doc, '$.occurred_at') IN ('VARCHAR', 'BIGINT', 'UBIGINT', 'DOUBLE')
         THEN TRY_CAST(json_extract_string(doc, '$.occurred_at') AS DOUBLE) END AS ts_number,
    CASE WHEN json_type(doc, '$.source_system') = 'VARCHAR' THEN json_extract_string(doc, '$.source_system') END
      AS source_system
  FROM j
),
g AS (
  SELECT *,
    CASE WHEN regexp_matches(ts_text, '{_ISO}') THEN
      TRY_CAST(concat(regexp_extract(ts_text, '{_ISO}', 1), ' ', replace(regexp_extract(ts_text, '{_ISO}', 2), ',', '.'),
        CASE WHEN length(regexp_extract(ts_text, '{_ISO}', 2)) = 5 THEN ':00' ELSE '' END) AS TIMESTAMP)
      - to_seconds(CASE WHEN regexp_extract(ts_text, '{_ISO}', 3) IN ('', 'Z', 'z') THEN 0
          ELSE (CASE WHEN left(regexp_extract(ts_text, '{_ISO}', 3), 1) = '-' THEN -1 ELSE 1 END)
             * (CAST(substr(regexp_replace(regexp_extract(ts_text, '{_ISO}', 3), '[^0-9]', '', 'g'), 1, 2) AS INTEGER) * 3600
              + CAST(substr(regexp_replace(regexp_extract(ts_text, '{_ISO}', 3), '[^0-9]', '', 'g'), 3, 2) AS INTEGER) * 60)
          END)
      WHEN ts_number IS NOT NULL THEN make_timestamp(CAST(round(ts_number * CASE WHEN abs(ts_number) > 20000000000 THEN 1000
          ELSE 1000000 END) AS BIGINT))
    END AS occurred_at,
    amount_dec IS NOT NULL AND amount_dec <> 0 AS amount_ok
  FROM f
),
parsed AS (
  SELECT *,
    CASE WHEN doc IS NULL THEN 'json_object' ELSE array_to_string(list_filter([
      CASE WHEN coalesce(length(event_id) >= 8, false) THEN NULL ELSE 'event_id' END,
      CASE WHEN coalesce(length(account_id) >= 1, false) THEN NULL ELSE 'account_id' END,
      CASE WHEN coalesce(amount_ok, false) THEN NULL ELSE 'amount_minor' END,
      CASE WHEN coalesce(regexp_full_match(currency, '\\p{{L}}{{3}}'), false) THEN NULL ELSE 'currency' END,
      CASE WHEN coalesce(direction IN ('debit', 'credit'), false) THEN NULL ELSE 'direction' END,
      CASE WHEN coalesce(transaction_type IN ('transfer', 'card_payment', 'fx_conversion', 'fee', 'refund'), false)
           THEN NULL ELSE 'transaction_type' END,
      CASE WHEN occurred_at IS NOT NULL THEN NULL ELSE 'occurred_at' END,
      CASE WHEN coalesce(length(source_system) >= 1, false) THEN NULL ELSE 'source_system' END
    ], lambda x: x IS NOT NULL), ',') END AS failed_rules
  FROM g
)"""
)

ORACLE["validate_json"] = _with(LINES_CTE) + """SELECT line_id, event_id, account_id,
    CAST(amount_dec AS BIGINT) AS amount_minor, currency, direction, transaction_type, occurred_at, source_system
  FROM parsed WHERE failed_rules = ''"""
ORACLE["dead_letter"] = _with(LINES_CTE) + "SELECT line_id, raw, failed_rules FROM parsed WHERE failed_rules <> ''"
QUERIES["typed_json_read"] = q_typed_json_read
ORACLE["typed_json_read"] = _with(CLEAN) + """SELECT event_id, account_id, amount_minor, currency, direction, transaction_type,
    occurred_at, source_system FROM c_base"""
QUERIES["validate_json"] = q_validate_json
QUERIES["dead_letter"] = q_dead_letter


# ---------------------------------------------------------------- streaming

def stream_drops(spark: SparkSession, drops: list[DataFrame]) -> str:
    """Land every drop (line_id, raw) and ingest it with an ``availableNow`` run of one stream (same checkpoint), so each
    run takes only the new files. Returns the folder that holds it all."""
    root = _fresh_dir(spark, "stream")
    for drop in drops:
        drop.select("raw").write.mode("append").text(f"{root}/landing")
        autoload_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/dead_letter", f"{root}/_checkpoint",
                        manifest_dir=f"{root}/manifest").awaitTermination()
    return root


#: Lines of the first drop; all others come with the second.
FIRST_DROP = "line_id LIKE 'evt-%' AND CAST(substr(line_id, 5) AS BIGINT) % 2 = 0"


def stream_run(spark: SparkSession, lines: DataFrame) -> str:
    """``lines`` in two drops."""
    even = F.expr("line_id LIKE 'evt-%' AND try_cast(substr(line_id, 5) AS BIGINT) % 2 = 0")
    return stream_drops(spark, [lines.filter(even), lines.filter(~even)])


def q_stream_ingest(spark, sf_dir):
    root = stream_run(spark, event_lines(spark, sf_dir))
    return _settled(spark, read_stream_bronze(spark, f"{root}/bronze").drop("ingested_at", "stream_epoch"), root)


def q_stream_dead_letter(spark, sf_dir):
    root = stream_run(spark, event_lines(spark, sf_dir))
    dead = read_dead_letter(spark, f"{root}/dead_letter")
    return _settled(spark, dead.select("raw", F.array_join("failed_rules", ",").alias("failed_rules")), root)


def q_streamed_silver(spark, sf_dir):
    """Silver of a build whose bronze is both landings: a batch of the events with an even id, and the stream's whole
    intake. An event of both arrived first with the batch, whose stamp lies in the past."""
    root = stream_run(spark, event_lines(spark, sf_dir))
    layers = {**path_layers(f"{root}/layers"), "stream": f"{root}/bronze"}
    even = event_records(table(spark, sf_dir, "events")).filter("_src % 2 = 0").drop("_src")
    land_batch(even, batch_id=LAND_BATCH_ID, ingested_at=LAND_STAMP).write.partitionBy("event_date").parquet(layers["bronze"])
    silver = build_medallion(spark, layers)["silver"]
    stamped = silver.withColumn("stamped", F.col("ingested_at") >= F.lit(LAND_STAMP.replace(tzinfo=None)).cast("timestamp_ntz"))
    out = _settled(spark, stamped.drop("ingested_at"), root)
    return out


QUERIES["stream_ingest"] = q_stream_ingest
QUERIES["stream_dead_letter"] = q_stream_dead_letter
QUERIES["streamed_silver"] = q_streamed_silver
ORACLE["stream_ingest"] = _with(LINES_CTE) + """SELECT event_id, account_id, CAST(amount_dec AS BIGINT) AS amount_minor,
    CASE WHEN direction = 'debit' THEN -abs(CAST(amount_dec AS BIGINT)) ELSE abs(CAST(amount_dec AS BIGINT)) END
      AS signed_amount_minor,
    currency, direction, transaction_type, occurred_at, CAST(occurred_at AS DATE) AS event_date, source_system,
    'autoloader' AS batch_id
  FROM parsed WHERE failed_rules = ''"""
ORACLE["stream_dead_letter"] = _with(LINES_CTE) + "SELECT raw, failed_rules FROM parsed WHERE failed_rules <> ''"


ORACLE["streamed_silver"] = _with(LINES_CTE) + f"""SELECT event_id, account_id, CAST(amount_dec AS BIGINT) AS amount_minor,
    CASE WHEN direction = 'debit' THEN -abs(CAST(amount_dec AS BIGINT)) ELSE abs(CAST(amount_dec AS BIGINT)) END
      AS signed_amount_minor,
    currency, direction, transaction_type, occurred_at, CAST(occurred_at AS DATE) AS business_date, source_system,
    CASE WHEN line_id LIKE 'evt-%' AND CAST(substr(line_id, 5) AS BIGINT) % 2 = 0 THEN '{LAND_BATCH_ID}' ELSE 'autoloader' END
      AS batch_id, true AS stamped
  FROM parsed WHERE failed_rules = ''"""


# ---------------------------------------------------------------- layout and table maintenance


def _catalog_bronze(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Clean bronze as a date-partitioned catalog table in a database of its own: (database, table, folder)."""
    root, database = _fresh_dir(spark, "catalog"), f"ledgerproof_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    name = f"{database}.bronze"
    bronze = bronze_fixture(table(spark, sf_dir, "events"), faulty=False, keep_src=False)
    bronze.write.format("parquet").partitionBy("event_date").saveAsTable(name)
    return database, name, root


def _maintained(spark: SparkSession, sf_dir: str, job: Callable[[str], object]) -> DataFrame:
    database, name, root = _catalog_bronze(spark, sf_dir)
    try:
        job(name)
        return _settled(spark, spark.read.table(name))
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
        remove_path(spark, root)


def q_compact_rows(spark, sf_dir):
    return _maintained(spark, sf_dir, lambda t: compact_table(spark, t, zorder_by=["account_id", "occurred_at"]))


def q_add_column(spark, sf_dir):
    return _maintained(spark, sf_dir, lambda t: add_column(spark, t, "note", "STRING"))


def q_zorder_rows(spark, sf_dir):
    from ledgerproof.operators.layout import zordered

    return zordered(table(spark, sf_dir, "events"), ["user_id", "value"])


def q_redistributed_rows(spark, sf_dir):
    """Partitions and rows after silver is dealt to 8 partitions, and after those are merged to 4 without a shuffle."""
    from ledgerproof.operators.layout import partition_sizes, redistributed

    wide = redistributed(_m(spark, sf_dir).silver, 8)
    narrow = redistributed(wide, 4, shuffle=False)
    counts = [partition_sizes(df).agg(F.count("*").alias("partitions"), F.sum("rows").alias("rows")).select(
        F.lit(name).alias("layout"), "partitions", "rows") for name, df in (("dealt", wide), ("merged", narrow))]
    return counts[0].unionByName(counts[1])


for _name in ("compact_rows", "add_column", "zorder_rows", "redistributed_rows"):
    QUERIES[_name] = globals()[f"q_{_name}"]

ORACLE["compact_rows"] = _with(CLEAN) + f"SELECT {O.BRONZE_COLS} FROM c_bronze"
ORACLE["add_column"] = _with(CLEAN) + f"SELECT {O.BRONZE_COLS}, CAST(NULL AS VARCHAR) AS note FROM c_bronze"
ORACLE["zorder_rows"] = "SELECT * FROM events"
ORACLE["redistributed_rows"] = _with(FAULTY) + """SELECT layout, partitions, CAST(count(*) AS BIGINT) AS rows
  FROM silver, (VALUES ('dealt', CAST(8 AS BIGINT)), ('merged', CAST(4 AS BIGINT))) l(layout, partitions) GROUP BY ALL"""


# ---------------------------------------------------------------- more checks and the serving export


def q_check_dedup_fallback(spark, sf_dir):
    """The two-argument dedup check with an empty target falls back to the source's totals."""
    m = _m(spark, sf_dir)
    raw = m.totals("bronze_raw")
    empty_target = m.totals("silver").filter(F.lit(False))
    return C.dedup_check_pair(raw, empty_target, layer="bronze").breaks


def q_reconcile_with_source_summary(spark, sf_dir):
    """The parity suite preceded by source -> bronze checks against the producer's manifest."""
    manifest = source_manifest(_m(spark, sf_dir, faulty=False).bronze)
    return _suite(spark, sf_dir, lambda r: r.summary, source=manifest)


def q_published_account_summary(spark, sf_dir):
    path = _fresh_dir(spark, "account-summary")
    publish_account_summary(_m(spark, sf_dir).dim, path)
    return _settled(spark, spark.read.parquet(path), path)


for _name in ("check_dedup_fallback", "reconcile_with_source_summary", "published_account_summary"):
    QUERIES[_name] = globals()[f"q_{_name}"]

ORACLE["check_dedup_fallback"] = ORACLE["check_dedup_bronze"]
ORACLE["published_account_summary"] = ORACLE["account_list"]
_MANIFEST = f"mt AS ({O.totals_sql('c_dedup', 'source', date_expr='event_date')})"
_RAW_BY_DATE = f"brt AS ({O.totals_sql('bronze', 'bronze_raw')})"
ORACLE["reconcile_with_source_summary"] = _with(FAULTY, CLEAN, T_BRONZE, T_SILVER, T_GOLD, T_GOLD_FAULT, _MANIFEST,
                                                _RAW_BY_DATE) + "\nUNION ALL\n".join(
    [
        O.summary_sql(O.row_check_sql("mt", "brt", "source", "bronze", distinct_target=True, evaluated=True), 1,
                      "row_count", "source", "bronze"),
        O.summary_sql(O.amount_check_sql("mt", "bt", "source", "bronze", evaluated=True), 2, "amount_sum", "source",
                      "bronze"),
    ]
    + [O.summary_sql(sql, i + 3, *rest) for i, (sql, *rest) in enumerate(_suite_evaluated("gt", "dim"))]
)


# ---------------------------------------------------------------- the build and control jobs on written tables

# The corrections: rows of this date without a currency get one, and events of the next one are delivered again with an
# earlier stamp and a date two days later.
CORRECTED_DATE, MOVED_DATE, ARRIVAL_DATE = "2024-01-03", "2024-01-17", "2024-01-19"


def q_build_job_silver(spark, sf_dir):
    layers, root = written_layers(spark, sf_dir)
    return _settled(spark, spark.read.parquet(layers["silver"]), root)


def q_build_job_control_summary(spark, sf_dir):
    return _suite(spark, sf_dir, lambda r: r.summary, mode="conservation")


def corrected_bronze(bronze: DataFrame) -> DataFrame:
    mended = bronze.withColumn("currency", F.when(
        F.col("event_date") == F.lit(CORRECTED_DATE).cast("date"), F.coalesce("currency", F.lit("GBP"))).otherwise(F.col("currency")))
    again = bronze.filter((F.col("event_date") == F.lit(MOVED_DATE).cast("date")) & (F.col("batch_id") == "b1")).filter(
        f"{EVENT_NUMBER} % 3 = 1")
    two_days = F.make_dt_interval(days=F.lit(2))
    moved = again.withColumn("ingested_at", F.col("occurred_at")).withColumn("batch_id", F.lit("b0")).withColumn(
        "occurred_at", F.col("occurred_at") + two_days).withColumn("event_date", F.to_date("occurred_at"))
    return mended.unionByName(moved)


def _incremental(spark, sf_dir, layer: str):
    """``layer`` after a full build, a correction of bronze and a build of the dates on which bronze changed."""
    layers, root = written_layers(spark, sf_dir)
    _rewritten(spark, layers["bronze"], "event_date", corrected_bronze)
    built = build_medallion(spark, layers, dates=[CORRECTED_DATE, ARRIVAL_DATE])
    return _settled(spark, built[layer], root)


def q_incremental_silver(spark, sf_dir):
    return _incremental(spark, sf_dir, "silver")


def q_incremental_rejected(spark, sf_dir):
    return _incremental(spark, sf_dir, "rejected")


def q_incremental_dim(spark, sf_dir):
    return _incremental(spark, sf_dir, "dim")


for _name in ("build_job_silver", "build_job_control_summary", "incremental_silver", "incremental_rejected", "incremental_dim"):
    QUERIES[_name] = globals()[f"q_{_name}"]
ORACLE["build_job_silver"] = ORACLE["silver_valid"]
ORACLE["build_job_control_summary"] = ORACLE["reconcile_conservation_summary"]
_CORRECTED = f"""fixed AS (
  SELECT * REPLACE (CASE WHEN event_date = DATE '{CORRECTED_DATE}' THEN coalesce(currency, 'GBP') ELSE currency END AS currency)
  FROM bronze
  UNION ALL
  SELECT * REPLACE (occurred_at + INTERVAL 2 DAY AS occurred_at, CAST(occurred_at + INTERVAL 2 DAY AS DATE) AS event_date,
    occurred_at AS ingested_at, 'b0' AS batch_id)
  FROM bronze WHERE event_date = DATE '{MOVED_DATE}' AND batch_id = 'b1' AND event_id IS NOT NULL AND {EVENT_NUMBER} % 3 = 1)"""
_AFTER = O.after_bronze_ctes("fixed", "n_")
ORACLE["incremental_silver"] = _with(FAULTY, _CORRECTED, _AFTER) + "SELECT * FROM n_silver"
ORACLE["incremental_rejected"] = _with(FAULTY, _CORRECTED, _AFTER) + "SELECT * FROM n_rejected"
ORACLE["incremental_dim"] = _with(FAULTY, _CORRECTED, _AFTER) + "SELECT * FROM n_dim"
