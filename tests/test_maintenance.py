"""File ranges and skipping, small-file merges, string boundaries."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ledgerproof.operators.layout import string_bounds, zordered
from ledgerproof.plans.maintenance import compact_small_files, data_files, file_ranges, files_to_read, merge_plan
from ledgerproof.sources.fixture import bronze_fixture


def _files(root):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_an_odd_key_does_not_spoil_string_ranks(spark):
    bronze = bronze_fixture(spark.read.parquet("/root/testdata/sf0.01/events.parquet"), faulty=False)
    odd = bronze.limit(1).withColumn("account_id", F.lit(""))
    mixed = bronze.unionByName(odd).unionByName(odd.withColumn("account_id", F.lit("\U0001d518" * 400)))
    clustered = zordered(mixed, ["account_id", "occurred_at"], 16)
    keys = clustered.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("account_id").alias("k")).agg(F.avg("k")).first()[0]
    assert keys <= 60


def test_boundaries_are_even_over_distinct_values(spark):
    hot = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit("k05000")).otherwise(
        F.concat(F.lit("k"), F.lpad((F.col("id") / 2).cast("int").cast("string"), 5, "0"))).alias("k"))
    bounds = string_bounds(hot, ["k"], 16)["k"]
    assert len(bounds) == 15 and bounds == sorted(bounds)
    sizes = [r["n"] for r in hot.distinct().groupBy(sum((F.col("k") >= b).cast("int") for b in bounds)).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 2 * min(sizes)
    assert string_bounds(spark.createDataFrame([(None,)], "k string"), ["k"], 8) == {"k": []}


def test_file_ranges_tell_what_a_filter_reads(spark, scratch):
    rows = spark.range(9000).select("id", F.concat(F.lit("k"), F.lpad(((F.col("id") * 7919) % 9000).cast("string"), 4, "0")).alias("k"),
                                    (F.col("id") - 4500).alias("signed"), F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("at"))
    plain, ranged = f"{scratch}/plain", f"{scratch}/ranged"
    rows.repartition(12).write.parquet(plain)
    zordered(rows, ["k"], 12).write.parquet(ranged)
    wanted = rows.where("k between 'k0100' and 'k0250'")
    counts = {}
    for path in (plain, ranged):
        table = spark.read.parquet(path)
        ranges = file_ranges(spark, path, ["k", "signed", "at"])
        assert ranges.count() == 36 and ranges.where("column = 'k'").agg(F.sum("rows")).first()[0] == 9000
        files = [r["file"] for r in files_to_read(ranges, table, "k", "k0100", "k0250").collect()]
        assert spark.read.parquet(*files).where("k between 'k0100' and 'k0250'").count() == wanted.count() == 151
        counts[path] = len(files)
        low = files_to_read(ranges, table, "signed", -4500, -4499)
        assert spark.read.parquet(*[r["file"] for r in low.collect()]).where("signed <= -4499").count() == 2
    assert counts[plain] == 12 and counts[ranged] <= 2
    spark.range(1).select(F.lit(1.5).alias("x")).write.parquet(f"{scratch}/x")
    with pytest.raises(ValueError, match="no ranges for x"):
        file_ranges(spark, f"{scratch}/x", ["x"])


def test_only_small_files_are_merged(spark, scratch):
    path = f"{scratch}/layer"
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("pad"),
                                      F.when(F.col("id") % 4 == 0, F.lit("2024-01-02")).otherwise("2024-01-01").alias("event_date"),
                                      F.when(F.col("id") % 2 == 0, F.lit("a b+%")).alias("part"))
    rows.where("id < 40000").coalesce(1).write.partitionBy("event_date", "part").parquet(path)
    rows.where("id >= 40000").repartition(10).write.mode("append").partitionBy("event_date", "part").parquet(path)
    before = _files(path)
    target = min(sorted(before.values())[-3:])
    big = {f for f, n in before.items() if n >= target * 0.5}
    assert 3 <= len(big) < 10 < len(before)
    assert data_files(spark, path).agg(F.sum("bytes")).first()[0] == sum(before.values())
    done = compact_small_files(spark, path, target_bytes=target, wave=7)
    after = _files(path)
    assert big <= set(after) and len(after) < len(before) and done["merged"] == len(set(before) - set(after))
    assert done["written"] == len(set(after) - set(before)) > 0
    got = spark.read.parquet(path).select("id", "pad", F.col("event_date").cast("string"), "part")
    assert got.exceptAll(rows).count() == 0 == rows.exceptAll(got).count()
    assert compact_small_files(spark, path, target_bytes=target) == {"merged": 0, "written": 0} and _files(path) == after
    assert merge_plan(data_files(spark, path), 1).count() == 0
