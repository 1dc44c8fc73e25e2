"""Where two layers differ: order-free checksums per bucket of keys, then the keys of the buckets that differ.

Control totals say that a date is off by so many rows; this names the rows. Both sides are cut to their key and a hash
of the compared columns; a bucket's checksum is its row count and the sum of those hashes, which no order changes. Equal
buckets are done: only rows of differing buckets are compared by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _hashed(df: DataFrame, key: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """key as one struct, bucket and content; NULLs are values, told apart from empty text by their own mark."""
    content = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    return df.select(F.struct(*[F.col(k).alias(k) for k in key]).alias("key"),
                     F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(buckets)).cast("int").alias("bucket"),
                     F.xxhash64(*content).cast("decimal(20,0)").alias("content"))


def bucket_checksums(df: DataFrame, key: Sequence[str], columns: Sequence[str], *, buckets: int = BUCKETS) -> DataFrame:
    """bucket, rows, checksum: a row per bucket, pre-aggregated per task."""
    return _hashed(df, key, columns, buckets).groupBy("bucket").agg(
        F.count("*").alias("rows"), F.sum("content").cast("decimal(38,0)").alias("checksum"))


def differing_buckets(source: DataFrame, target: DataFrame, key: Sequence[str], columns: Sequence[str], *,
                      buckets: int = BUCKETS) -> DataFrame:
    """Buckets whose rows or checksums differ, with both sides' row counts."""
    a = bucket_checksums(source, key, columns, buckets=buckets).withColumnsRenamed({"rows": "source_rows", "checksum": "_a"})
    b = bucket_checksums(target, key, columns, buckets=buckets).withColumnsRenamed({"rows": "target_rows", "checksum": "_b"})
    both = a.join(b, "bucket", "full_outer")
    return both.where(~(F.col("_a").eqNullSafe(F.col("_b")) & F.col("source_rows").eqNullSafe(F.col("target_rows")))).select(
        "bucket", F.coalesce("source_rows", F.lit(0)).alias("source_rows"), F.coalesce("target_rows", F.lit(0)).alias("target_rows"))


def _verdict() -> Column:
    return (F.when(F.col("target_rows") == 0, "lost").when(F.col("source_rows") == 0, "added")
            .when(F.col("target_rows") > F.col("source_rows"), "copied")
            .when(F.col("target_rows") < F.col("source_rows"), "fewer").otherwise("changed"))


def differing_keys(source: DataFrame, target: DataFrame, key: str | Sequence[str], columns: Sequence[str], *,
                   buckets: int = BUCKETS) -> DataFrame:
    """One row per key whose rows differ: the key columns, verdict (lost, added, copied, fewer, changed) and both sides'
    row counts. A NULL key is a key.

    Each side is read twice: once for the buckets (nothing but sums is shuffled), once for the rows of the buckets that
    differ, which are counted per key before they meet. The differing buckets, ``buckets`` rows at most, are all that is
    broadcast, if Spark finds them small."""
    key = [key] if isinstance(key, str) else list(key)
    off = differing_buckets(source, target, key, columns, buckets=buckets).select("bucket")

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = _hashed(df, key, columns, buckets).join(off, "bucket", "left_semi")
        none, one = F.lit(0).cast("decimal(20,0)"), F.col("content")
        return rows.groupBy("key").agg(*[
            agg for s in ("source", "target") for agg in (
                F.count(F.when(F.lit(s == name), 1)).alias(f"{s}_rows"),
                F.sum(F.when(F.lit(s == name), one).otherwise(none)).cast("decimal(38,0)").alias(f"_{s}"))])

    both = side(source, "source").unionByName(side(target, "target")).groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("source_rows", "target_rows", "_source", "_target")])
    off_keys = both.where((F.col("source_rows") != F.col("target_rows")) | (F.col("_source") != F.col("_target")))
    return off_keys.select("key.*", _verdict().alias("verdict"), "source_rows", "target_rows")
