"""Job drivers: build, control, maintain, publish. Each does its work as Spark jobs and acts only on small results
(a row per check, a list of calendar dates).

A job takes its layers as one mapping ``layer -> name`` (``catalog_layers`` or ``path_layers``); a name with a slash
is a folder, any other a table. An optional ``stream`` layer names the folder the ingestion stream writes, and bronze
is then both landings together. Intermediate tables lie in the shared folder named by ``spark.checkpoint.dir``, so a
lost executor re-reads them, and are deleted when the job ends, also when it fails.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.operators.dedup import dedup_bronze
from ledgerproof.operators.layout import compacted, rebalanced, zordered
from ledgerproof.operators.medallion import (
    account_days,
    classify,
    dim_from_days,
    drop_fx_conversions,
    fact_transactions,
    rejected_of,
    silver_of,
)
from ledgerproof.operators.report import Report
from ledgerproof.plans.suite import reconciliation_suite
from ledgerproof.schemas import (
    ACCOUNT_DAYS_SCHEMA,
    BRONZE_COLUMNS,
    BRONZE_SCHEMA,
    DIM_ACCOUNT_SCHEMA,
    FACT_SCHEMA,
    REJECTED_SCHEMA,
    SILVER_SCHEMA,
)
from ledgerproof.session import materialize_at, remove_path
from ledgerproof.sources.landing import is_path, replace_dates, replace_table
from ledgerproof.streaming.autoload import read_stream_bronze

LAYER_SCHEMAS = {
    "bronze": BRONZE_SCHEMA,
    "silver": SILVER_SCHEMA,
    "rejected": REJECTED_SCHEMA,
    "fact": FACT_SCHEMA,
    "days": ACCOUNT_DAYS_SCHEMA,
    "dim": DIM_ACCOUNT_SCHEMA,
}
#: Partition column of the layers that have one.
DATED = {"bronze": "event_date", "silver": "business_date", "rejected": "event_date", "fact": "business_date",
         "days": "business_date"}


@contextmanager
def _scratch(df: DataFrame, label: str):
    """``df`` written to the shared folder for the time of the block."""
    written, path = materialize_at(df, label)
    try:
        yield written
    finally:
        remove_path(df.sparkSession, path)


def read_layer(spark: SparkSession, layers: dict[str, str], layer: str) -> DataFrame:
    """A layer with its declared schema (an empty partitioned layer has no files to infer from); bronze with the
    stream's landings, where ``layers`` names them."""
    schema, name = LAYER_SCHEMAS[layer], layers[layer]
    rows = spark.read.schema(schema).parquet(name) if is_path(name) else spark.read.table(name)
    rows = rows.select(*schema.fieldNames())
    if layer == "bronze" and "stream" in layers:
        rows = rows.unionByName(read_stream_bronze(spark, layers["stream"]).select(*BRONZE_COLUMNS))
    return rows


def _on(df: DataFrame, column: str, dates: Sequence[date]) -> DataFrame:
    """Restrict to ``dates``; on a table partitioned by ``column`` this is partition pruning."""
    return df.filter(F.col(column).isin([F.lit(d) for d in dates]))


def affected_dates(bronze: DataFrame, built: DataFrame, dates: Sequence[date]) -> list[date]:
    """``dates`` and every date on which a key of theirs was delivered or is kept now (``built``: event_id,
    event_date of silver and quarantine). A redelivery can move an event to another date, so those dates change too.
    The list holds calendar dates only."""
    seen = bronze.select("event_id", "event_date").unionByName(built)
    keys = _on(seen, "event_date", dates).select("event_id").filter("event_id IS NOT NULL").distinct()
    touched = seen.join(keys, "event_id", "left_semi").select("event_date").distinct()
    return sorted({*dates, *(r["event_date"] for r in touched.collect())})


def deliveries_for(bronze: DataFrame, dates: Sequence[date]) -> DataFrame:
    """All bronze rows that decide what ``dates`` hold: every delivery of the keys delivered then, whatever its date,
    and the rows of those dates without a key."""
    then = _on(bronze, "event_date", dates)
    keys = then.select("event_id").filter("event_id IS NOT NULL").distinct()
    return bronze.join(keys, "event_id", "left_semi").select(*bronze.columns).unionByName(then.filter("event_id IS NULL"))


def build_medallion(spark: SparkSession, layers: dict[str, str], *, inject_break: bool = False,
                    dates: Sequence[str | date] | None = None) -> dict[str, DataFrame]:
    """Bronze -> silver + quarantine -> gold fact, account days and dimension; returns the layers as read back.

    With ``dates`` (those on which bronze changed) the run is incremental and leaves what a full build would: it
    rebuilds the partitions of ``affected_dates``, an affected date that holds nothing any more loses its partition,
    and the dimension is put together again from the account days.
    """
    bronze = read_layer(spark, layers, "bronze")
    only: list[date] | None = None
    if dates:
        asked = [date.fromisoformat(d) if isinstance(d, str) else d for d in dates]
        built = read_layer(spark, layers, "silver").select("event_id", F.col("business_date").alias("event_date")).unionByName(
            read_layer(spark, layers, "rejected").select("event_id", "event_date"))
        only = affected_dates(bronze, built, asked)
        bronze = deliveries_for(bronze, only)

    def put(df: DataFrame, layer: str) -> None:
        column = DATED[layer]
        if only is None:
            replace_table(rebalanced(df, column), layers[layer], partition_by=(column,))
        else:
            replace_dates(rebalanced(_on(df, column, only), column), layers[layer], column, only)

    with _scratch(classify(dedup_bronze(bronze)), "classified") as classified:
        put(silver_of(classified), "silver")
        put(rejected_of(classified), "rejected")
    silver = read_layer(spark, layers, "silver")
    silver = _on(silver, "business_date", only) if only else silver
    silver = drop_fx_conversions(silver) if inject_break else silver
    put(fact_transactions(silver), "fact")
    put(account_days(silver), "days")
    replace_table(dim_from_days(read_layer(spark, layers, "days")), layers["dim"])
    return {layer: read_layer(spark, layers, layer) for layer in LAYER_SCHEMAS}


def run_control(spark: SparkSession, layers: dict[str, str], *, mode: str = "parity", tolerance_minor: int = 0,
                relative_tolerance: float = 0.0, raise_on_error: bool = True, report_path: str | None = None,
                dates: Sequence[str | date] | None = None, source: DataFrame | None = None) -> Report:
    """The reconciliation suite over the written layers; raises ``ReconciliationFailure`` on an ERROR, with every
    break written to ``report_path`` if that is given. ``discard`` the report when done with it.

    With ``dates`` the checks cover those dates only (partition pruning on every layer); bronze is deduplicated from
    all deliveries of their keys, and referential integrity checks those dates' facts against the whole dimension.
    """
    frames = {layer: read_layer(spark, layers, layer) for layer in ("bronze", "silver", "rejected", "fact", "dim")}
    deduped = None
    if dates:
        asked = [date.fromisoformat(d) if isinstance(d, str) else d for d in dates]
        deduped = _on(dedup_bronze(deliveries_for(frames["bronze"], asked)), "event_date", asked)
        frames |= {layer: _on(frames[layer], DATED[layer], asked) for layer in ("bronze", "silver", "rejected", "fact")}
    suite = reconciliation_suite(
        frames["bronze"], frames["silver"], frames["fact"], frames["dim"], rejected=frames["rejected"], source=source,
        bronze_deduped=deduped, mode=mode, tolerance_minor=tolerance_minor, relative_tolerance=relative_tolerance,
        materialize=True,
    )
    try:
        report = suite.materialize()
    finally:
        suite.discard()
    if raise_on_error:
        try:
            report.raise_for_status(report_path)
        except Exception:
            report.discard()
            raise
    return report


def publish_account_summary(dim: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    """Low-latency readers get ``account_summary`` as files keyed (and clustered) by ``account_id``;
    lookups read it with a pushed-down filter. No server, and nothing passes through the driver."""
    summary = dim.select("account_id", "transaction_count", "net_amount_minor")
    summary.repartitionByRange("account_id").sortWithinPartitions("account_id").write.mode("overwrite").format(
        fmt
    ).save(path)


def publish_account_lookup(dim: DataFrame, table: str, *, buckets: int = 256) -> None:
    """The summary as a table for point lookups: bucketed and sorted by ``account_id``, with a bloom filter per row group.

    A lookup by ``account_id`` reads the one bucket that can hold it (bucket pruning), and in it the row groups whose
    bounds and bloom filter do not rule the account out. The shuffle by bucket is the writer's own single one."""
    summary = dim.select("account_id", "transaction_count", "net_amount_minor")
    (summary.repartition(buckets, "account_id").write.mode("overwrite").format("parquet")
     .option("parquet.bloom.filter.enabled#account_id", "true").bucketBy(buckets, "account_id").sortBy("account_id")
     .saveAsTable(table))


def partition_columns(spark: SparkSession, table: str) -> tuple[str, ...]:
    """Partition columns of a catalog table, in order."""
    return tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)


def compact_table(spark: SparkSession, table: str, *, zorder_by: Sequence[str] | None = None,
                  target_partitions: int | None = None) -> int:
    """Maintenance for a plain (unversioned) table: rewrite it as fewer, larger files, optionally Z-ordered, with
    the partition columns the catalog has for it. The rows are staged once in the shared folder (a table cannot be
    overwritten while it is being read) and the stage is deleted only once the table holds as many rows as it."""
    columns, parts = spark.read.table(table).columns, partition_columns(spark, table)
    staged, path = materialize_at(spark.read.table(table), "compact")
    laid_out = zordered(staged, list(zorder_by), target_partitions) if zorder_by else compacted(staged, target_partitions)
    replace_table(laid_out.select(*columns), table, partition_by=parts)
    before, after = staged.count(), spark.read.table(table).count()
    if before != after:
        raise RuntimeError(f"{table} holds {after} rows after compaction, {before} before; the rows are in {path}")
    remove_path(spark, path)
    return after


def add_column(spark: SparkSession, table: str, name: str, kind: str) -> None:
    """A new nullable column at the end of a table; existing files are not rewritten and read as NULL there."""
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({name} {kind})")
