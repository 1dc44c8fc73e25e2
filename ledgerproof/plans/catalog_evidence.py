"""Registered queries on evidence, maintenance and schema change: where a break comes from, what a stream lost or brought
late, which files a filter reads, totals that merge, drops of several schemas, sorted outputs and a failing run.
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerproof.operators.control_totals import control_totals, key_partials, merged_partials, totals_of_partials
from ledgerproof.operators.layout import zordered
from ledgerproof.operators.medallion import account_lookup
from ledgerproof.operators.report import ReconciliationFailure, run_all
from ledgerproof.operators.trace import differing_keys
from ledgerproof.plans import oracle as O
from ledgerproof.plans.catalog import (
    CLEAN,
    COPIED_ROW,
    EVENT_NUMBER,
    FAULTY,
    FIRST_DROP,
    LINES_CTE,
    LOOKUP_ACCOUNT,
    LOST_ROW,
    ORACLE as CORE_ORACLE,
    T_BRONZE,
    T_GOLD_FAULT,
    T_SILVER,
    Query,
    _fresh_dir,
    _m,
    _settled,
    _suite_evaluated,
    _with,
    damaged_silver,
    event_lines,
    stream_drops,
    stream_run,
    table,
    written_layers,
)
from ledgerproof.plans.jobs import publish_account_lookup, run_control
from ledgerproof.plans.maintenance import compact_small_files, data_files, file_ranges, files_to_read
from ledgerproof.schemas import BRONZE_COLUMNS, SILVER_COLUMNS
from ledgerproof.session import materialize_at, remove_path
from ledgerproof.sources.evolve import land_evolved, read_evolved
from ledgerproof.sources.fixture import bronze_fixture
from ledgerproof.streaming.autoload import (
    epoch_checks,
    read_manifest,
    read_stream_bronze,
    unique_stream,
    windowed_totals,
)

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
CHANGED_ROW = f"{EVENT_NUMBER} % 307 = 11"


def _numbered(df: DataFrame) -> DataFrame:
    """The rows with their place in the order they come out in."""
    placed = df.withColumn("_at", F.monotonically_increasing_id())
    return placed.withColumn("place", F.row_number().over(Window.orderBy("_at"))).drop("_at")


# ---------------------------------------------------------------- where a break comes from


def q_differing_keys(spark, sf_dir):
    """Rows of silver that were lost, copied or changed after the build, by event: deduplicated, valid bronze against silver."""
    layers, root = written_layers(spark, sf_dir)
    damaged_silver(spark, layers)
    silver = spark.read.parquet(layers["silver"])
    silver = silver.withColumn("signed_amount_minor", F.when(F.expr(CHANGED_ROW), F.col("signed_amount_minor") + 1).otherwise(
        F.col("signed_amount_minor")))
    return _settled(spark, differing_keys(_m(spark, sf_dir).silver, silver, "event_id", SILVER_COLUMNS[1:]), root)


QUERIES["differing_keys"] = q_differing_keys
ORACLE["differing_keys"] = _with(FAULTY, f"""hurt AS (
  SELECT * REPLACE (CASE WHEN {CHANGED_ROW} THEN signed_amount_minor + 1 ELSE signed_amount_minor END AS signed_amount_minor) FROM (
    SELECT {O.SILVER_COLS} FROM silver WHERE NOT ({LOST_ROW}) UNION ALL SELECT {O.SILVER_COLS} FROM silver WHERE {COPIED_ROW})),
a AS (SELECT event_id, count(*) AS source_rows, list_sort(list(md5(to_json(s)::VARCHAR))) AS rows_ FROM (SELECT {O.SILVER_COLS} FROM silver) s GROUP BY 1),
b AS (SELECT event_id, count(*) AS target_rows, list_sort(list(md5(to_json(s)::VARCHAR))) AS rows_ FROM hurt s GROUP BY 1)""") + """
SELECT coalesce(a.event_id, b.event_id) AS event_id,
  CASE WHEN b.event_id IS NULL THEN 'lost' WHEN a.event_id IS NULL THEN 'added' WHEN target_rows > source_rows THEN 'copied'
       WHEN target_rows < source_rows THEN 'fewer' ELSE 'changed' END AS verdict,
  coalesce(source_rows, 0) AS source_rows, coalesce(target_rows, 0) AS target_rows
FROM a FULL OUTER JOIN b ON a.event_id = b.event_id WHERE a.rows_ IS DISTINCT FROM b.rows_"""


# ---------------------------------------------------------------- streams: redeliveries, late rows, lost rows


def q_stream_unique(spark, sf_dir):
    """Two drops, the second with every third line of the first again; the second stage keeps each event once."""
    lines = event_lines(spark, sf_dir).where("line_id LIKE 'evt-%'")
    first = F.expr(FIRST_DROP)
    again = lines.where(first & F.expr("CAST(substr(line_id, 5) AS BIGINT) % 3 = 0"))
    root = stream_drops(spark, [lines.where(first), lines.where(~first).unionByName(again)])
    for _ in range(2):  # the second run finds nothing new
        unique_stream(spark, f"{root}/bronze", f"{root}/unique", f"{root}/_unique").awaitTermination()
    unique = spark.read.parquet(f"{root}/unique").select(*[c for c in BRONZE_COLUMNS if c != "ingested_at"], "stream_epoch")
    landed = read_stream_bronze(spark, f"{root}/bronze").groupBy(F.col("event_id").alias("_id")).agg(F.count("*").alias("deliveries"))
    return _settled(spark, unique.join(landed, F.col("event_id") == F.col("_id")).drop("_id"), root)


_STREAMED = """SELECT event_id, account_id, CAST(amount_dec AS BIGINT) AS amount_minor,
    CASE WHEN direction = 'debit' THEN -abs(CAST(amount_dec AS BIGINT)) ELSE abs(CAST(amount_dec AS BIGINT)) END
      AS signed_amount_minor,
    currency, direction, transaction_type, occurred_at, CAST(occurred_at AS DATE) AS event_date, source_system,
    'autoloader' AS batch_id"""
_NUMBER = "CAST(substr(line_id, 5) AS BIGINT)"
QUERIES["stream_unique"] = q_stream_unique
ORACLE["stream_unique"] = _with(LINES_CTE) + f"""{_STREAMED}, CAST({_NUMBER} % 2 AS BIGINT) AS stream_epoch,
    CAST(CASE WHEN {_NUMBER} % 6 = 0 THEN 2 ELSE 1 END AS BIGINT) AS deliveries
  FROM (SELECT * FROM parsed WHERE line_id LIKE 'evt-%' AND failed_rules = '') p"""

DELAY = timedelta(days=2)


def _event_stream(spark, sf_dir) -> str:
    return stream_run(spark, event_lines(spark, sf_dir).where("line_id LIKE 'evt-%'"))


def q_stream_windows(spark, sf_dir):
    """On-time and late totals per business date; the second drop is late wherever its date had closed."""
    root = _event_stream(spark, sf_dir)
    out = windowed_totals(read_stream_bronze(spark, f"{root}/bronze"), read_manifest(spark, f"{root}/manifest"), DELAY)
    return _settled(spark, out, root)


_EPOCHS = f"""rows_ AS (
  SELECT {_NUMBER} % 2 AS epoch, occurred_at, CASE WHEN direction = 'debit' THEN -abs(amount_dec) ELSE abs(amount_dec) END AS amount,
    CAST(occurred_at AS DATE) AS day
  FROM (SELECT * FROM parsed WHERE line_id LIKE 'evt-%' AND failed_rules = '') p),
marks AS (SELECT max(occurred_at) FILTER (WHERE epoch = 0) - INTERVAL 2 DAY AS mark, max(occurred_at) - INTERVAL 2 DAY AS now FROM rows_)"""
_LATE = "(epoch = 1 AND day + INTERVAL 1 DAY <= mark)"
QUERIES["stream_windows"] = q_stream_windows
ORACLE["stream_windows"] = _with(LINES_CTE, _EPOCHS) + f"""SELECT CAST(day AS VARCHAR) AS partition_key,
    count(*) FILTER (WHERE NOT {_LATE}) AS on_time_rows,
    CAST(coalesce(sum(amount) FILTER (WHERE NOT {_LATE}), 0) AS BIGINT) AS on_time_amount, count(*) FILTER (WHERE {_LATE}) AS late_rows,
    CAST(coalesce(sum(amount) FILTER (WHERE {_LATE}), 0) AS BIGINT) AS late_amount, bool_and(day + INTERVAL 1 DAY <= now) AS closed
  FROM rows_, marks GROUP BY day"""


def q_stream_epoch_breaks(spark, sf_dir):
    """The stream's epochs against their manifests after the second epoch lost some rows behind the stream's back."""
    root = _event_stream(spark, sf_dir)
    bronze = read_stream_bronze(spark, f"{root}/bronze").where(f"NOT (stream_epoch = 1 AND {LOST_ROW})")
    return _settled(spark, run_all(epoch_checks(bronze, read_manifest(spark, f"{root}/manifest"))).breaks, root)


_EPOCH_TOTALS = """{name} AS (
  SELECT '{layer}' AS layer, CAST({number} % 2 AS VARCHAR) AS partition_key, count(*) AS row_count,
    CAST(sum(CASE WHEN direction = 'debit' THEN -abs(amount_dec) ELSE abs(amount_dec) END) AS BIGINT) AS amount_minor_sum,
    CAST(NULL AS BIGINT) AS distinct_event_ids
  FROM (SELECT * FROM parsed WHERE line_id LIKE 'evt-%' AND failed_rules = '') p WHERE {where} GROUP BY 2)"""
QUERIES["stream_epoch_breaks"] = q_stream_epoch_breaks
ORACLE["stream_epoch_breaks"] = _with(
    LINES_CTE, _EPOCH_TOTALS.format(name="told", layer="manifest", number=_NUMBER, where="true"),
    _EPOCH_TOTALS.format(name="held", layer="stream", number=_NUMBER, where=f"NOT ({_NUMBER} % 2 = 1 AND {LOST_ROW})"),
) + O.row_check_sql("told", "held", "manifest", "stream") + "\nUNION ALL\n" + O.amount_check_sql("told", "held", "manifest", "stream")


# ---------------------------------------------------------------- totals that merge


def q_merged_totals(spark, sf_dir):
    """Bronze totals from stored partials plus a correction's own: rows taken away, and others that arrive on a later date."""
    bronze = _m(spark, sf_dir).bronze
    kept, path = materialize_at(key_partials(bronze), "key-partials")
    gone = bronze.where(LOST_ROW)
    moved = bronze.where(COPIED_ROW).withColumn("occurred_at", F.col("occurred_at") + F.make_dt_interval(days=F.lit(1)))
    whole = merged_partials(kept, key_partials(gone, sign=-1), key_partials(moved))
    return _settled(spark, totals_of_partials(whole, "bronze"), path)


QUERIES["merged_totals"] = q_merged_totals
ORACLE["merged_totals"] = _with(FAULTY, f"""after_ AS (
  SELECT * FROM bronze WHERE ({LOST_ROW}) IS NOT TRUE
  UNION ALL SELECT * REPLACE (occurred_at + INTERVAL 1 DAY AS occurred_at) FROM bronze WHERE {COPIED_ROW})""") + O.totals_sql("after_", "bronze")


# ---------------------------------------------------------------- files: skipping, merging, lookups, schema changes

RANGE = ("ACC-00003", "ACC-00006")


def q_skipped_files(spark, sf_dir):
    """Bronze by account range, read from the listed files only: as landed, where no file can be skipped, and clustered."""
    bronze = bronze_fixture(table(spark, sf_dir, "events"), faulty=False, keep_src=False)
    out, roots = [], []
    for layout, laid in (("landed", bronze.repartition(16)), ("clustered", zordered(bronze, ["account_id"], 16))):
        path = _fresh_dir(spark, "files")
        roots.append(path)
        laid.write.parquet(path)
        ranges, range_path = materialize_at(file_ranges(spark, path, ["account_id", "occurred_at"]), "file-ranges")
        roots.append(range_path)
        files = [r["file"] for r in files_to_read(ranges, bronze, "account_id", *RANGE).collect()]
        whole = ranges.select("file").distinct().count()
        rows = spark.read.parquet(*files) if files else spark.read.parquet(path).limit(0)
        found = rows.where(F.col("account_id").between(*RANGE))
        out.append(found.groupBy("account_id").agg(F.count("*").alias("rows")).select(
            F.lit(layout).alias("layout"), F.lit(len(files) <= whole / 2).alias("skips"), "account_id", "rows"))
    return _settled(spark, out[0].unionByName(out[1]), *roots)


QUERIES["skipped_files"] = q_skipped_files
ORACLE["skipped_files"] = _with(CLEAN) + f"""SELECT layout, layout = 'clustered' AS skips, account_id, count(*) AS rows
  FROM c_bronze, (VALUES ('landed'), ('clustered')) l(layout) WHERE account_id BETWEEN '{RANGE[0]}' AND '{RANGE[1]}' GROUP BY ALL"""


def q_compact_small_rows(spark, sf_dir):
    """Bronze landed in four drops, its small files merged; a file a date is left, and a second run has nothing to do."""
    path = _fresh_dir(spark, "small")
    bronze = bronze_fixture(table(spark, sf_dir, "events"), faulty=False, keep_src=False)
    for k in range(4):
        bronze.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == k).write.mode("append").partitionBy("event_date").parquet(path)
    done = compact_small_files(spark, path)
    again = compact_small_files(spark, path)
    files = data_files(spark, path).groupBy("folder").count().agg(F.max("count")).first()[0]
    if not done["merged"] or again["merged"] or files != 1:
        raise RuntimeError(f"merge left {files} files a date: {done}, then {again}")
    return _settled(spark, spark.read.parquet(path).select(*BRONZE_COLUMNS), path)


QUERIES["compact_small_rows"] = q_compact_small_rows
ORACLE["compact_small_rows"] = _with(CLEAN) + f"SELECT {O.BRONZE_COLS} FROM c_bronze"


def q_evolved_layer(spark, sf_dir):
    """Order drops of three generations read together: a narrow number, then a wide one, then one column more and one less."""
    orders, root = table(spark, sf_dir, "orders"), _fresh_dir(spark, "drops")
    part = F.col("o_orderkey") % 3
    narrow = orders.select(F.col("o_orderkey").cast("int").alias("o_orderkey"), F.col("o_totalprice"), "o_orderstatus")
    wide = orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    more = orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    drops: list[str] = []
    for k, df in enumerate((narrow, wide, more)):
        land_evolved(df.where(part == k), drops, f"{root}/drop={k}")
        drops.append(f"{root}/drop={k}")
    return _settled(spark, read_evolved(spark, drops), root)


QUERIES["evolved_layer"] = q_evolved_layer
ORACLE["evolved_layer"] = """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 < 2 THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS o_orderpriority FROM orders"""


def published_lookup(spark: SparkSession, dim: DataFrame, database: str, buckets: int = 16) -> DataFrame:
    publish_account_lookup(dim, f"{database}.account_lookup", buckets=buckets)
    return account_lookup(spark.read.table(f"{database}.account_lookup"), LOOKUP_ACCOUNT)


def q_published_account_lookup(spark, sf_dir):
    """A lookup in the published, bucketed summary, which reads one bucket."""
    root, database = _fresh_dir(spark, "lookup"), f"ledgerproof_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    try:
        return _settled(spark, published_lookup(spark, _m(spark, sf_dir).dim, database))
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
        remove_path(spark, root)


QUERIES["published_account_lookup"] = q_published_account_lookup
ORACLE["published_account_lookup"] = CORE_ORACLE["account_lookup"]


# ---------------------------------------------------------------- sorted outputs, a failing run


def q_totals_in_order(spark, sf_dir):
    """Control totals in the order they come out in."""
    return _numbered(control_totals(_m(spark, sf_dir).silver, "silver", ordered=True))


def q_breaks_in_order(spark, sf_dir):
    """Breaks of a control run in report order: by check, then partition key."""
    layers, root = written_layers(spark, sf_dir, inject_break=True)
    report = run_control(spark, layers, raise_on_error=False)
    return _settled(spark, _numbered(report.ordered_breaks()), root, *report.scratch)


QUERIES["totals_in_order"] = q_totals_in_order
ORACLE["totals_in_order"] = _with(FAULTY, T_SILVER) + "SELECT *, row_number() OVER (ORDER BY partition_key) AS place FROM st"
QUERIES["breaks_in_order"] = q_breaks_in_order
_FAULT_CHECKS = "\nUNION ALL\n".join(
    f'SELECT {i + 1} AS step, * EXCLUDE (is_break) FROM ({sql}) e WHERE is_break' for i, (sql, *_) in enumerate(_suite_evaluated("gft", "dim_fault")))
ORACLE["breaks_in_order"] = _with(FAULTY, T_BRONZE, T_SILVER, T_GOLD_FAULT) + f"""SELECT * EXCLUDE (step),
  row_number() OVER (ORDER BY step, partition_key) AS place FROM ({_FAULT_CHECKS}) b"""


def q_failed_control_run(spark, sf_dir):
    """What a failing control run leaves: it raises, and the folder it names holds every break."""
    layers, root = written_layers(spark, sf_dir, inject_break=True)
    try:
        run_control(spark, layers, report_path=f"{root}/report").discard()
        raised = None
    except ReconciliationFailure as failure:
        raised = str(failure).partition(";")[0]
    lines = spark.read.text(f"{root}/report/text").select(F.lit(raised).alias("raised"), F.col("value").alias("line"))
    return _settled(spark, lines, root)


QUERIES["failed_control_run"] = q_failed_control_run
ORACLE["failed_control_run"] = f"""WITH l AS ({CORE_ORACLE["report_lines"]})
SELECT (SELECT line FROM l WHERE line LIKE 'reconciliation %') AS raised, line FROM l"""
