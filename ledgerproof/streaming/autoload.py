"""Incremental file ingestion into bronze with Structured Streaming.

``readStream.text`` over a landing folder discovers new files; the checkpoint records which files were
taken, so each file is processed once. Every micro-batch goes through the same validator as the batch
path: valid events get the bronze expressions (signed amount, event date, ingestion stamp, batch id),
so the stream emits the full 12-column bronze schema; malformed or invalid lines go to a dead letter
with the names of the failed rules instead of failing the query.

Both outputs are written by ``foreachBatch`` as a dynamic overwrite of the partition
``stream_epoch=<batch id>``, so a micro-batch replayed after a failure replaces its own output instead
of appending it twice. Stream output and batch landing live in different folders; naming the former as the
``stream`` layer makes the build and control jobs read both as bronze.

With a ``manifest_dir`` every epoch also leaves one manifest row, observed on its own writes: rows, amount, dead
letters and the latest business time. ``epoch_checks`` holds the written epochs against it, and ``windowed_totals``
tells on-time from late rows by the watermark that the manifest implies, losing neither.

``unique_stream`` is a second stage over the bronze that the first one writes: keyed state with expiry keeps an event
that is delivered again, in whatever later micro-batch, out of its output.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerproof.functions.time import utc_wall_clock
from ledgerproof.operators.checks import CheckResult, amount_sum_check, row_count_check
from ledgerproof.operators.control_totals import control_totals
from ledgerproof.schemas import BRONZE_COLUMNS, BRONZE_SCHEMA
from ledgerproof.sources.json_lines import parse_event_lines
from ledgerproof.session import materialize_at, remove_path
from ledgerproof.sources.landing import to_bronze

STREAM_BATCH_ID = "autoloader"
# Paces the stream: a backlog is split into micro-batches of about this many bytes of new files.
DEFAULT_MAX_BYTES_PER_TRIGGER = 1 << 30
MANIFEST_SCHEMA = "rows bigint, amount_minor_sum bigint, dead_rows bigint, latest timestamp_ntz, stream_epoch bigint"


def _epoch_writer(bronze_dir: str, dead_letter_dir: str, batch_id: str, manifest_dir: str | None = None):
    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        # parsed once, into a table both outputs read; a lost executor costs a re-read, not a parse
        parsed, scratch = materialize_at(parse_event_lines(batch, raw="raw"), "stream-epoch")
        try:
            valid = parsed.filter(F.size("failed_rules") == 0)
            bronze = to_bronze(
                valid,
                ingested_at=utc_wall_clock(F.current_timestamp()),
                batch_id=F.lit(batch_id),
            ).withColumn("stream_epoch", F.lit(epoch_id).cast("bigint"))
            landed, refused = Observation(), Observation()
            (
                bronze.observe(landed, F.count(F.lit(1)).alias("rows"), F.sum("signed_amount_minor").alias("amount"),
                               F.max("occurred_at").alias("latest"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("stream_epoch", "event_date")
                .parquet(bronze_dir)
            )
            dead = parsed.filter(F.size("failed_rules") > 0).select(
                "source_file", "raw", "failed_rules", F.lit(epoch_id).cast("bigint").alias("stream_epoch")
            )
            (
                dead.observe(refused, F.count(F.lit(1)).alias("rows"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("stream_epoch")
                .parquet(dead_letter_dir)
            )
            if manifest_dir:
                got = landed.get
                row = (int(got["rows"] or 0), int(got["amount"] or 0), int(refused.get["rows"] or 0), got["latest"], epoch_id)
                batch.sparkSession.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic").partitionBy("stream_epoch").parquet(manifest_dir)
        finally:
            remove_path(batch.sparkSession, scratch)

    return write_epoch


def autoload_stream(
    spark: SparkSession,
    landing_dir: str,
    bronze_dir: str,
    dead_letter_dir: str,
    checkpoint_dir: str,
    *,
    batch_id: str = STREAM_BATCH_ID,
    max_bytes_per_trigger: int | None = DEFAULT_MAX_BYTES_PER_TRIGGER,
    available_now: bool = True,
    manifest_dir: str | None = None,
) -> StreamingQuery:
    """Start the ingestion stream; with ``available_now`` it takes what has landed and stops."""
    reader = spark.readStream.format("text")
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    raw = reader.load(landing_dir).select(
        F.col("value").alias("raw"), F.col("_metadata.file_path").alias("source_file")
    )
    writer = (
        raw.writeStream.foreachBatch(_epoch_writer(bronze_dir, dead_letter_dir, batch_id, manifest_dir))
        .option("checkpointLocation", checkpoint_dir)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_stream_bronze(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """Bronze rows written by the stream (bronze columns plus ``stream_epoch``)."""
    return spark.read.parquet(bronze_dir).select(*BRONZE_COLUMNS, "stream_epoch")


def read_dead_letter(spark: SparkSession, dead_letter_dir: str) -> DataFrame:
    return spark.read.parquet(dead_letter_dir)


STREAM_SCHEMA = T.StructType([*BRONZE_SCHEMA.fields, T.StructField("stream_epoch", T.LongType())])


def read_manifest(spark: SparkSession, manifest_dir: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_dir)


def epoch_checks(bronze: DataFrame, manifest: DataFrame) -> list[CheckResult]:
    """Rows and amounts of every written epoch against its manifest: a row that went missing after the write, or an epoch
    written twice, breaks. An epoch of dead letters only has no rows on either side."""
    told = manifest.where("rows > 0").select(
        F.lit("manifest").alias("layer"), F.col("stream_epoch").cast("string").alias("partition_key"),
        F.col("rows").alias("row_count"), "amount_minor_sum", F.lit(None).cast("bigint").alias("distinct_event_ids"))
    held = control_totals(bronze, "stream", partition_col="stream_epoch", with_distinct=False)
    return [row_count_check(told, held, source_layer="manifest", target_layer="stream"),
            amount_sum_check(told, held, source_layer="manifest", target_layer="stream")]


def watermarks(manifest: DataFrame, delay: timedelta) -> DataFrame:
    """stream_epoch, watermark: the latest business time of all earlier epochs less ``delay`` (NULL for the first)."""
    earlier = Window.orderBy("stream_epoch").rowsBetween(Window.unboundedPreceding, -1)  # a row per epoch
    return manifest.select("stream_epoch", (F.max("latest").over(earlier) - F.lit(delay)).alias("watermark"))


def windowed_totals(bronze: DataFrame, manifest: DataFrame, delay: timedelta) -> DataFrame:
    """partition_key, on_time_rows, on_time_amount, late_rows, late_amount, closed: totals per business date.

    A row is late if its date had ended by the watermark of its epoch; it is counted as such and its date's on-time totals
    stay what was told when the date closed. ``closed`` dates ended by the watermark that the next epoch will have."""
    marks = watermarks(manifest, delay).withColumnRenamed("stream_epoch", "_epoch")
    now = manifest.agg((F.max("latest") - F.lit(delay)).alias("now")).scalar()
    day = F.date_trunc("DAY", F.col("occurred_at")).cast("timestamp_ntz")
    rows = bronze.join(marks, F.col("stream_epoch") == F.col("_epoch"), "left").withColumn("_end", day + F.lit(timedelta(days=1)))
    rows = rows.withColumn("_late", F.coalesce(F.col("_end") <= F.col("watermark"), F.lit(False)))
    amount = F.col("signed_amount_minor")
    totals = rows.groupBy(F.to_date("occurred_at").cast("string").alias("partition_key"), "_end").agg(
        F.count_if(~F.col("_late")).alias("on_time_rows"),
        F.coalesce(F.sum(F.when(~F.col("_late"), amount)), F.lit(0)).cast("bigint").alias("on_time_amount"),
        F.count_if(F.col("_late")).alias("late_rows"),
        F.coalesce(F.sum(F.when(F.col("_late"), amount)), F.lit(0)).cast("bigint").alias("late_amount"))
    return totals.withColumn("closed", F.coalesce(F.col("_end") <= now, F.lit(False))).drop("_end")


def unique_stream(
    spark: SparkSession,
    bronze_dir: str,
    unique_dir: str,
    checkpoint_dir: str,
    *,
    within: str = "30 days",
    available_now: bool = True,
) -> StreamingQuery:
    """Start the second stage: every event id once, whichever epoch brings it again within ``within`` of its arrival.

    State is one key per event and expires by the arrival stamp's watermark, so it is bounded by that time's intake. An
    epoch that was replayed has new files with the same ids, which are dropped like any other redelivery."""
    rows = spark.readStream.schema(STREAM_SCHEMA).parquet(bronze_dir)
    arrived = rows.withColumn("_arrived", F.col("ingested_at").cast("timestamp"))
    first = arrived.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["event_id"])
    writer = (
        first.select(*BRONZE_COLUMNS, "stream_epoch").writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_dir).option("path", unique_dir).partitionBy("event_date").outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
