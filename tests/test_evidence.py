"""Where breaks come from, merging totals, schema changes, atomic dates, lookups, stream evidence."""

from __future__ import annotations

import glob
import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerproof.operators.control_totals import control_totals, key_partials, merged_partials, totals_of_partials
from ledgerproof.operators.dedup import first_arrival
from ledgerproof.operators.report import run_all
from ledgerproof.operators.trace import differing_buckets, differing_keys
from ledgerproof.plans.catalog_evidence import published_lookup
from ledgerproof.sources.evolve import SchemaConflict, land_evolved, merged_schema, read_evolved
from ledgerproof.sources.landing import replace_dates
from ledgerproof.streaming.autoload import (
    autoload_stream,
    epoch_checks,
    read_manifest,
    read_stream_bronze,
    unique_stream,
    windowed_totals,
)

from .conftest import ts
from .test_json_stream import GOOD


# ---- trace

ROWS = "k string, a bigint, b string"


def test_differing_keys_name_every_kind_of_difference(spark):
    source = [("same", 1, "x"), ("lost", 2, None), ("copied", 3, "c"), ("changed", 4, "d"), ("null", 5, None), ("fewer", 6, "e"),
              ("fewer", 6, "e"), (None, 7, "n"), ("swap", 8, "p"), ("swap", 9, "q"), ("swapped", 1, "p"), ("swapped", 2, "q")]
    target = [("same", 1, "x"), ("copied", 3, "c"), ("copied", 3, "c"), ("changed", 4, "D"), ("null", 5, ""), ("fewer", 6, "e"),
              ("added", 1, "z"), (None, 7, "m"), ("swap", 9, "q"), ("swap", 8, "p"), ("swapped", 1, "q"), ("swapped", 2, "p")]
    s, t = spark.createDataFrame(source, ROWS), spark.createDataFrame(target, ROWS)
    for buckets in (1, 7, 4096):
        got = {r["k"]: r["verdict"] for r in differing_keys(s, t, "k", ["a", "b"], buckets=buckets).collect()}
        assert got == {"lost": "lost", "copied": "copied", "changed": "changed", "null": "changed", "fewer": "fewer", "added": "added",
                       None: "changed", "swapped": "changed"}
    assert differing_keys(s, s.orderBy(F.rand(3)), "k", ["a", "b"]).count() == 0
    assert differing_buckets(s.limit(0), t, ["k"], ["a", "b"]).count() > 0 == differing_keys(s.limit(0), t.limit(0), "k", ["a"]).count()


# ---- totals that merge


def test_merged_partials_equal_counting_again(spark):
    schema = "event_id string, signed_amount_minor bigint, business_date string"
    base = [("a", 5, "d1"), ("a", 5, "d1"), ("b", None, "d1"), (None, 1, "d1"), ("c", 7, "d2"), ("c", 7, None)]
    gone, new = [("a", 5, "d1"), ("c", 7, "d2"), (None, 1, "d1")], [("b", 3, "d1"), ("z", 9, "d3"), ("z", 9, "d3")]
    left = [("a", 5, "d1"), ("b", None, "d1"), ("c", 7, None), *new]
    df = [spark.createDataFrame(x, schema) for x in (base, gone, new, left)]
    merged = merged_partials(key_partials(df[0]), key_partials(df[1], sign=-1), key_partials(df[2]))
    got = {tuple(r) for r in totals_of_partials(merged, "x").collect()}
    assert got == {tuple(r) for r in control_totals(df[3], "x").collect()}


# ---- schema change


def test_drops_of_several_schemas_read_together(spark, scratch):
    frames = [spark.createDataFrame([(1, "x")], "id int, t string"), spark.createDataFrame([(2**40, 1.5)], "ID bigint, f float"),
              spark.createDataFrame([(3, 2.5, None)], "id smallint, f double, t string"), spark.createDataFrame([(4, "y")], "id int, t string")]
    drops = []
    for k, df in enumerate(frames):
        land_evolved(df, drops, f"{scratch}/{k}")
        drops.append(f"{scratch}/{k}")
    out = read_evolved(spark, drops)
    assert out.schema.simpleString() == "struct<id:bigint,t:string,f:double>"
    assert sorted(map(tuple, out.collect())) == [(1, "x", None), (3, None, 2.5), (4, "y", None), (2**40, None, 1.5)]
    with pytest.raises(SchemaConflict, match=r"column t: string in .*/0, date in .*/new"):
        land_evolved(spark.createDataFrame([(date(2024, 1, 1),)], "t date"), drops, f"{scratch}/new")
    assert not os.path.exists(f"{scratch}/new")
    with pytest.raises(SchemaConflict, match="column id: .*bigint in .*, string in"):
        merged_schema({d: spark.read.parquet(d).schema for d in drops} | {"s": spark.createDataFrame([], "id string").schema})


# ---- dates are swapped or left


def test_a_failing_replace_leaves_the_old_dates(spark, scratch):
    target, d1, d2, d3 = f"{scratch}/layer", date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
    rows = spark.createDataFrame([(1, d1), (2, d2), (3, d3)], "id int, day date")
    rows.write.partitionBy("day").parquet(target)

    def held():
        return sorted((r["id"], r["day"]) for r in spark.read.parquet(target).collect())

    broken = spark.createDataFrame([(10, d1), (11, d2)], "id int, day date").withColumn(
        "id", F.when(F.col("id") == 11, F.raise_error(F.lit("no")).cast("int")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        replace_dates(broken, target, "day", [d1, d2])
    assert held() == [(1, d1), (2, d2), (3, d3)]
    replace_dates(spark.createDataFrame([(10, d1)], "id int, day date"), target, "day", [d1, d2])
    assert held() == [(3, d3), (10, d1)] and not os.path.exists(f"{target}/day=2024-01-02")


def test_replace_dates_of_a_table(spark, scratch):
    spark.sql(f"CREATE DATABASE swap_dates LOCATION '{scratch}/db'")
    try:
        d1, d2, d3 = (date(2024, 1, d) for d in (1, 2, 3))
        spark.createDataFrame([(1, d1), (2, d2), (3, d3)], "id int, day date").write.partitionBy("day").saveAsTable("swap_dates.t")
        replace_dates(spark.createDataFrame([(d1, 10)], "day date, id int"), "swap_dates.t", "day", [d1, d2])
        assert sorted(map(tuple, spark.read.table("swap_dates.t").collect())) == [(3, d3), (10, d1)]
    finally:
        spark.sql("DROP DATABASE swap_dates CASCADE")


# ---- one read, one bucket


def test_first_arrival_reads_its_input_once(spark, scratch):
    rows = spark.createDataFrame([(None, ts(2026, 9, 1))] * 3 + [("E", ts(2026, 9, 2)), ("E", ts(2026, 9, 1))], "event_id string, ingested_at timestamp_ntz")
    rows.write.parquet(f"{scratch}/in")
    kept = first_arrival(spark.read.parquet(f"{scratch}/in"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("WindowGroupLimit") == 2
    assert kept.columns == rows.columns and sorted(r["event_id"] or "" for r in kept.collect()) == ["", "", "", "E"]
    assert kept.where("event_id = 'E'").first()["ingested_at"] == ts(2026, 9, 1)


def test_a_lookup_opens_one_bucket(spark, scratch):
    dim = spark.range(200).select(F.format_string("ACC-%05d", "id").alias("account_id"), F.col("id").alias("transaction_count"),
                                  (F.col("id") * 2).alias("net_amount_minor"))
    spark.sql(f"CREATE DATABASE one_bucket LOCATION '{scratch}/db'")
    try:
        found = published_lookup(spark, dim, "one_bucket", buckets=8)
        held = found.select(F.input_file_name()).first()[0].rsplit("/", 1)[-1]
        files = glob.glob(f"{scratch}/db/account_lookup/*.parquet")
        assert len(files) == 8
        for f in files:  # whoever opens another bucket fails
            if os.path.basename(f) != held:
                size = os.path.getsize(f)
                with open(f, "wb") as out:
                    out.write(b"x" * size)
        for crc in glob.glob(f"{scratch}/db/account_lookup/.*.crc"):
            os.unlink(crc)
        assert [tuple(r) for r in found.collect()] == [("ACC-00042", 42, 84)]
        with pytest.raises(Exception):
            spark.read.table("one_bucket.account_lookup").agg(F.sum("transaction_count")).collect()
    finally:
        spark.sql("DROP DATABASE one_bucket CASCADE")


# ---- streams


def _stream(spark, root):
    def drop(*events):
        lines = [(json.dumps({**GOOD, **e}) if isinstance(e, dict) else e,) for e in events]
        spark.createDataFrame(lines, "raw string").coalesce(1).write.mode("append").text(f"{root}/landing")
        autoload_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/dead", f"{root}/_ck", manifest_dir=f"{root}/manifest").awaitTermination()

    return drop


def _event(n, at, amount=100):
    return {"event_id": f"EVENT-{n:04d}", "occurred_at": at, "amount_minor": amount, "direction": "credit"}


def test_redeliveries_of_later_batches_stay_out(spark, scratch):
    drop = _stream(spark, scratch)

    def run():
        unique_stream(spark, f"{scratch}/bronze", f"{scratch}/unique", f"{scratch}/_u").awaitTermination()
        return sorted(r["event_id"] for r in spark.read.parquet(f"{scratch}/unique").collect())

    drop(_event(1, "2026-09-01"), _event(2, "2026-09-01"), _event(2, "2026-09-01"))
    assert run() == ["EVENT-0001", "EVENT-0002"]
    drop(_event(2, "2026-09-01"), _event(3, "2026-09-02"), "{bad")
    assert run() == ["EVENT-0001", "EVENT-0002", "EVENT-0003"]
    drop(_event(1, "2026-09-01"))
    assert run() == ["EVENT-0001", "EVENT-0002", "EVENT-0003"]
    assert read_stream_bronze(spark, f"{scratch}/bronze").count() == 6


def test_late_rows_are_counted_and_lost_rows_break(spark, scratch):
    drop = _stream(spark, scratch)
    drop(_event(1, "2026-09-01", 5), _event(2, "2026-09-04", 7))
    drop(_event(3, "2026-09-01", 11), _event(4, "2026-09-03", 13), "{bad")  # the first of September closed with the first drop
    drop(_event(5, "2026-09-09", 17))
    bronze, manifest = read_stream_bronze(spark, f"{scratch}/bronze"), read_manifest(spark, f"{scratch}/manifest")
    assert sorted((r["stream_epoch"], r["rows"], r["amount_minor_sum"], r["dead_rows"], r["latest"]) for r in manifest.collect()) == [
        (0, 2, 12, 0, datetime(2026, 9, 4)), (1, 2, 24, 1, datetime(2026, 9, 3)), (2, 1, 17, 0, datetime(2026, 9, 9))]
    got = {r["partition_key"]: tuple(r)[1:] for r in windowed_totals(bronze, manifest, timedelta(days=1)).collect()}
    assert got == {"2026-09-01": (1, 5, 1, 11, True), "2026-09-03": (1, 13, 0, 0, True), "2026-09-04": (1, 7, 0, 0, True),
                   "2026-09-09": (1, 17, 0, 0, False)}
    assert run_all(epoch_checks(bronze, manifest)).status()["passed"]
    lost = run_all(epoch_checks(bronze.where("event_id <> 'EVENT-0004'"), manifest)).breaks.collect()
    assert [(r["check"], r["partition_key"], r["delta"]) for r in lost] == [("row_count", "1", -1), ("amount_sum", "1", -13)]
