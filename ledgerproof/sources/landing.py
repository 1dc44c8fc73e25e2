"""Landing events in bronze, table replace, bootstrap and table naming.

Batch landing takes a DataFrame (never Python row objects), stamps it, and appends it partitioned by
``event_date``. The row count comes from an ``Observation`` on the write itself, so landing is one
pass over the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerproof.functions.money import signed_amount
from ledgerproof.functions.time import utc_wall_clock
from ledgerproof.schemas import BRONZE_COLUMNS, BRONZE_SCHEMA
from ledgerproof.session import remove_path


#: The default table name of every layer, by schema (the three schemas are the caller's).
TABLE_NAMES = {
    "bronze": ("bronze", "transactions_raw"),
    "silver": ("silver", "silver_transactions"),
    "rejected": ("silver", "silver_transactions_rejected"),
    "fact": ("gold", "fct_transaction"),
    "days": ("gold", "account_days"),
    "dim": ("gold", "dim_account"),
}


def catalog_layers(catalog: str = "spark_catalog", **schemas: str) -> dict[str, str]:
    """Layer -> three-level table name; ``bronze=``, ``silver=`` and ``gold=`` rename a schema."""
    unknown = set(schemas) - {schema for schema, _ in TABLE_NAMES.values()}
    if unknown:
        raise ValueError(f"no such schema: {', '.join(sorted(unknown))}")
    return {layer: ".".join((catalog, schemas.get(schema, schema), name)) for layer, (schema, name) in TABLE_NAMES.items()}


def path_layers(root: str) -> dict[str, str]:
    """Layer -> folder under ``root``."""
    return {layer: f"{root}/{layer}" for layer in TABLE_NAMES}


def is_path(name: str) -> bool:
    """A layer's name is a folder if it holds a slash, else a table."""
    return "/" in name


def stamp_literal(stamp: datetime) -> F.Column:
    """A driver-side instant as a ``timestamp_ntz`` holding its UTC wall clock."""
    utc = stamp.astimezone(UTC) if stamp.tzinfo else stamp
    return F.lit(utc.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def default_batch_id(stamp: datetime) -> str:
    return f"batch-{stamp.astimezone(UTC).strftime('%Y%m%d%H%M%S')}"


def to_bronze(events: DataFrame, *, ingested_at: F.Column, batch_id: F.Column) -> DataFrame:
    """Eight event fields -> the twelve bronze columns (signed amount, event date, lineage)."""
    occurred = F.col("occurred_at")
    if dict(events.dtypes).get("occurred_at") == "timestamp":
        occurred = utc_wall_clock(occurred)
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("account_id").cast("string").alias("account_id"),
        F.col("amount_minor").cast("bigint").alias("amount_minor"),
        signed_amount(F.col("amount_minor").cast("bigint"), "direction").alias("signed_amount_minor"),
        F.col("currency").alias("currency"),
        F.col("direction").alias("direction"),
        F.col("transaction_type").alias("transaction_type"),
        occurred.alias("occurred_at"),
        occurred.cast("date").alias("event_date"),
        F.col("source_system").alias("source_system"),
        ingested_at.alias("ingested_at"),
        batch_id.alias("batch_id"),
    )


def land_batch(
    events: DataFrame, *, batch_id: str | None = None, ingested_at: datetime | None = None
) -> DataFrame:
    """One stamp and one batch id for every row of the batch (default id ``batch-<UTC yyyymmddHHMMSS>``)."""
    stamp = ingested_at or datetime.now(UTC)
    return to_bronze(
        events,
        ingested_at=stamp_literal(stamp),
        batch_id=F.lit(batch_id or default_batch_id(stamp if stamp.tzinfo else stamp.replace(tzinfo=UTC))),
    )


def ingest_batch(
    events: DataFrame,
    target: str,
    *,
    batch_id: str | None = None,
    ingested_at: datetime | None = None,
) -> int:
    """Append a stamped batch to bronze; returns the number of rows written (0 writes nothing)."""
    observed = Observation("landed")
    frame = land_batch(events, batch_id=batch_id, ingested_at=ingested_at).observe(
        observed, F.count(F.lit(1)).alias("rows")
    )
    writer = frame.write.mode("append").partitionBy("event_date")
    if is_path(target):
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)
    return int(observed.get.get("rows", 0) or 0)


def replace_table(df: DataFrame, target: str, *, partition_by: tuple[str, ...] = ()) -> None:
    """Full replace. ``overwrite`` works on Parquet tables directly; no drop-then-create needed."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_path(target):
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)


def replace_dates(df: DataFrame, target: str, column: str, dates: Sequence[date]) -> None:
    """Replace the partitions of ``dates`` with what ``df`` holds for them: a date without rows loses its partition.

    The write is one dynamic partition overwrite: Spark swaps a date's files when the job commits, so a job that fails
    leaves every old partition. Dates that ``df`` holds nothing for (the write reports which it saw) are dropped after
    it. ``df`` must not read ``target``. Other dates and the session's settings stay untouched."""
    spark, folder = df.sparkSession, target
    if not is_path(target):
        df = df.select(*spark.read.table(target).columns)
        folder = spark.sql(f"DESCRIBE TABLE EXTENDED {target}").where("col_name = 'Location'").first()["data_type"]
    seen = Observation("dates")
    observed = df.observe(seen, F.collect_set(F.col(column).cast("string")).alias("dates"))
    observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(folder)
    filled = set(seen.get.get("dates") or ())
    for d in dates:
        day = d.isoformat()
        if is_path(target):
            if day not in filled:
                remove_path(spark, f"{target}/{column}={day}")
        else:  # the catalog learns of new dates; an emptied one goes there and on disk
            change = "ADD IF NOT EXISTS" if day in filled else "DROP IF EXISTS"
            spark.sql(f"ALTER TABLE {target} {change} PARTITION ({column} = DATE'{day}')")
    if not is_path(target):
        spark.catalog.refreshTable(target)


def bronze_ddl(table: str) -> str:
    cols = ",\n    ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in BRONZE_SCHEMA.fields)
    return f"CREATE TABLE IF NOT EXISTS {table} (\n    {cols}\n)\nUSING PARQUET\nPARTITIONED BY (event_date)"


def bootstrap(spark: SparkSession, layers: dict[str, str]) -> None:
    """Idempotent: the layers' schemas, and the bronze table partitioned by the plain ``event_date`` column."""
    for schema in dict.fromkeys(name.rpartition(".")[0] for name in layers.values()):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    spark.sql(bronze_ddl(layers["bronze"]))


def read_bronze(spark: SparkSession, target: str) -> DataFrame:
    if is_path(target):
        return spark.read.schema(BRONZE_SCHEMA).parquet(target).select(*BRONZE_COLUMNS)
    return spark.read.table(target).select(*BRONZE_COLUMNS)
