"""Control totals: per partition, row count, signed amount sum and distinct key count.

The aggregation is one ``groupBy``; Catalyst plans the distinct count as a partial aggregate on
(partition, key) shuffled by both, then a merge shuffled by partition, so neither a hot date nor a
hot key lands in one task with all its rows. The result stays a DataFrame (one row per partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerproof.operators.dedup import dedup_bronze
from ledgerproof.schemas import CONTROL_TOTALS_SCHEMA

_TOTAL_COLUMNS = [f.name for f in CONTROL_TOTALS_SCHEMA.fields]


def partition_key(column: str) -> F.Column:
    """The partition value as text; a NULL partition is the string ``'None'``."""
    return F.coalesce(F.col(column).cast("string"), F.lit("None"))


def with_business_date(df: DataFrame, partition_col: str = "business_date") -> DataFrame:
    """Derive ``business_date`` from ``occurred_at`` when it is asked for and absent (plan-time check)."""
    if partition_col == "business_date" and "business_date" not in df.columns:
        return df.withColumn("business_date", F.to_date("occurred_at"))
    return df


def control_totals(
    df: DataFrame,
    layer: str,
    *,
    partition_col: str = "business_date",
    amount_column: str = "signed_amount_minor",
    key_column: str = "event_id",
    dedupe: bool = False,
    key_unique: bool = False,
    with_distinct: bool = True,
    ordered: bool = False,
) -> DataFrame:
    """``layer, partition_key, row_count, amount_minor_sum, distinct_event_ids`` for any table.

    ``key_unique`` declares that each non-NULL key occurs once in ``df`` (true by construction right
    after a dedup in the same plan); the distinct count is then a plain non-NULL count, which saves the
    shuffle of every (partition, key) pair. Never set it for a stored layer whose uniqueness is what a
    check is meant to prove. ``with_distinct=False`` leaves ``distinct_event_ids`` NULL for layers whose
    distinct count no check reads (it would cost that same shuffle for nothing).
    """
    frame = with_business_date(df, partition_col)
    if dedupe:
        frame = dedup_bronze(frame, key_column=key_column)
        key_unique = True
    if not with_distinct:
        distinct = F.lit(None).cast("bigint")
    elif key_unique:
        distinct = F.count(F.col(key_column))
    else:
        distinct = F.count_distinct(F.col(key_column))
    totals = frame.groupBy(partition_key(partition_col).alias("partition_key")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(F.col(amount_column).cast("bigint")), F.lit(0).cast("bigint")).alias("amount_minor_sum"),
        distinct.alias("distinct_event_ids"),
    )
    totals = totals.select(F.lit(layer).alias("layer"), *[c for c in _TOTAL_COLUMNS if c != "layer"])
    return totals.orderBy("partition_key") if ordered else totals


def source_manifest(bronze: DataFrame, *, layer: str = "source") -> DataFrame:
    """What the producer knows: per date, the rows and signed sum of *unique* events."""
    unique = dedup_bronze(bronze)
    return control_totals(unique, layer, partition_col="event_date", key_unique=True)


def manifest_totals(bronze: DataFrame) -> DataFrame:
    """One row: unique events and duplicate deliveries (rows minus distinct ids)."""
    return bronze.agg(
        F.count_distinct("event_id").alias("unique_events"),
        (F.count(F.lit(1)) - F.count_distinct("event_id")).alias("duplicates"),
    )


def invariant_violations(totals: DataFrame) -> DataFrame:
    """Totals that break ``row_count >= 0``, ``distinct >= 0`` and ``distinct <= row_count``."""
    return totals.filter(
        (F.col("row_count") < 0)
        | (F.col("distinct_event_ids") < 0)
        | (F.col("distinct_event_ids") > F.col("row_count"))
    ).withColumn(
        "violation",
        F.when((F.col("row_count") < 0) | (F.col("distinct_event_ids") < 0), F.lit("negative count")).otherwise(
            F.lit("distinct exceeds rows")
        ),
    )


def duplicate_keys(totals: DataFrame) -> DataFrame:
    """Partition keys that appear more than once within a layer."""
    return (
        totals.groupBy("layer", "partition_key")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def assert_valid_totals(totals: DataFrame) -> DataFrame:
    """The same totals, failing the query (lazily, inside the plan) on a duplicate key or a broken invariant.

    Totals hold one row per partition, so the window here is over a tiny frame.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy("layer", "partition_key"))
    bad_counts = (
        (F.col("row_count") < 0)
        | (F.col("distinct_event_ids") < 0)
        | (F.col("distinct_event_ids") > F.col("row_count"))
    )
    guarded = totals.withColumn("_n", n).filter(
        F.when(
            F.col("_n") > 1,
            F.raise_error(F.concat(F.lit("duplicate control total for partition "), F.col("partition_key"))),
        )
        .when(
            bad_counts,
            F.raise_error(F.concat(F.lit("invalid control total for partition "), F.col("partition_key"))),
        )
        .otherwise(F.lit(True))
        .cast("boolean")
    )
    return guarded.drop("_n")


# ---- totals that merge


def key_partials(df: DataFrame, *, partition_col: str = "business_date", key_column: str = "event_id",
                 amount_column: str = "signed_amount_minor", sign: int = 1) -> DataFrame:
    """partition_key, key, rows, amount: a layer's totals kept per partition and key, so they can be added up.

    With ``sign=-1`` the rows count as taken away. Write them partitioned by ``partition_key``: a correction then adds its
    own few rows, and a control run sums partials of the partitions it checks instead of reading the layer again."""
    frame = with_business_date(df, partition_col)
    amount = F.coalesce(F.sum(F.col(amount_column).cast("bigint")), F.lit(0))
    return frame.groupBy(partition_key(partition_col).alias("partition_key"), F.col(key_column).cast("string").alias("key")).agg(
        (F.count(F.lit(1)) * sign).alias("rows"), (amount * sign).cast("bigint").alias("amount"))


def merged_partials(*partials: DataFrame) -> DataFrame:
    """Partials added up; a key without rows left is gone."""
    whole = partials[0]
    for more in partials[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("partition_key", "key").agg(F.sum("rows").alias("rows"), F.sum("amount").alias("amount")).where("rows <> 0")


def totals_of_partials(partials: DataFrame, layer: str) -> DataFrame:
    """``control_totals`` from merged partials: a key is one row here, so its distinct count is a plain count."""
    return partials.groupBy("partition_key").agg(
        F.sum("rows").alias("row_count"), F.sum("amount").alias("amount_minor_sum"), F.count("key").alias("distinct_event_ids")
    ).select(F.lit(layer).alias("layer"), *[c for c in _TOTAL_COLUMNS if c != "layer"])
