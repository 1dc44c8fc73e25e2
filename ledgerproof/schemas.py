"""One StructType per table. Every reader and writer in the package takes these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Fixed values that must match the reference: column order of bronze, the enums, the check
# and layer vocabulary, and the rejection reasons.
BRONZE_COLUMNS = (
    "event_id",
    "account_id",
    "amount_minor",
    "signed_amount_minor",
    "currency",
    "direction",
    "transaction_type",
    "occurred_at",
    "event_date",
    "source_system",
    "ingested_at",
    "batch_id",
)
SILVER_COLUMNS = (
    "event_id",
    "account_id",
    "amount_minor",
    "signed_amount_minor",
    "currency",
    "direction",
    "transaction_type",
    "occurred_at",
    "business_date",
    "source_system",
    "ingested_at",
    "batch_id",
)
FACT_COLUMNS = (
    "event_id",
    "account_id",
    "currency",
    "business_date",
    "occurred_at",
    "direction",
    "transaction_type",
    "signed_amount_minor",
    "source_system",
)
EVENT_FIELDS = (
    "event_id",
    "account_id",
    "amount_minor",
    "currency",
    "direction",
    "transaction_type",
    "occurred_at",
    "source_system",
)
DIRECTIONS = ("debit", "credit")
TRANSACTION_TYPES = ("transfer", "card_payment", "fx_conversion", "fee", "refund")
LAYERS = ("source", "bronze", "silver", "gold")
SEVERITIES = ("error", "warning")
REJECTION_REASONS = ("missing_event_id", "missing_currency", "zero_amount", "unknown")

# Timestamps are stored as TIMESTAMP_NTZ holding the UTC wall clock (the test Parquet reads that
# way), so no result depends on the session time zone.
BRONZE_SCHEMA = StructType(
    [
        StructField("event_id", StringType()),
        StructField("account_id", StringType()),
        StructField("amount_minor", LongType()),
        StructField("signed_amount_minor", LongType()),
        StructField("currency", StringType()),
        StructField("direction", StringType()),
        StructField("transaction_type", StringType()),
        StructField("occurred_at", TimestampNTZType()),
        StructField("event_date", DateType()),
        StructField("source_system", StringType()),
        StructField("ingested_at", TimestampNTZType()),
        StructField("batch_id", StringType()),
    ]
)

# The 8-field JSON event as it arrives on the wire (reference read schema: zone-aware timestamp).
EVENT_JSON_SCHEMA = StructType(
    [
        StructField("event_id", StringType()),
        StructField("account_id", StringType()),
        StructField("amount_minor", LongType()),
        StructField("currency", StringType()),
        StructField("direction", StringType()),
        StructField("transaction_type", StringType()),
        StructField("occurred_at", TimestampType()),
        StructField("source_system", StringType()),
    ]
)

CONTROL_TOTALS_SCHEMA = StructType(
    [
        StructField("layer", StringType()),
        StructField("partition_key", StringType()),
        StructField("row_count", LongType()),
        StructField("amount_minor_sum", LongType()),
        StructField("distinct_event_ids", LongType()),
    ]
)

BREAKS_SCHEMA = StructType(
    [
        StructField("check", StringType()),
        StructField("partition_key", StringType()),
        StructField("source_layer", StringType()),
        StructField("target_layer", StringType()),
        StructField("expected", LongType()),
        StructField("actual", LongType()),
        StructField("delta", LongType()),
        StructField("severity", StringType()),
        StructField("note", StringType()),
    ]
)

SUMMARY_SCHEMA = StructType(
    [
        StructField("check", StringType()),
        StructField("passed", BooleanType()),
        StructField("partitions_compared", LongType()),
        StructField("breaks", LongType()),
    ]
)

def _fields(*names: str) -> list[StructField]:
    by_name = {f.name: f for f in BRONZE_SCHEMA.fields}
    by_name["business_date"] = StructField("business_date", DateType())
    return [by_name[n] for n in names]


SILVER_SCHEMA = StructType(_fields(*SILVER_COLUMNS))
REJECTED_SCHEMA = StructType([*BRONZE_SCHEMA.fields, StructField("rejection_reason", StringType())])
FACT_SCHEMA = StructType(_fields(*FACT_COLUMNS))
DIM_ACCOUNT_SCHEMA = StructType(
    [
        StructField("account_id", StringType()),
        StructField("first_seen_at", TimestampNTZType()),
        StructField("last_seen_at", TimestampNTZType()),
        StructField("transaction_count", LongType()),
        StructField("net_amount_minor", LongType()),
    ]
)
ACCOUNT_DAYS_SCHEMA = StructType([StructField("business_date", DateType()), *DIM_ACCOUNT_SCHEMA.fields])
