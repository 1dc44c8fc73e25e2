"""End to end over the fixture: land, build, reconcile (reference pins + conservation decisions)."""

from __future__ import annotations

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from ledgerproof.operators.control_totals import control_totals
from ledgerproof.operators.medallion import classify, split_bronze, status_counts
from ledgerproof.operators.dedup import dedup_bronze
from ledgerproof.operators.report import ReconciliationFailure
from ledgerproof.plans.jobs import (
    add_column,
    build_medallion,
    compact_table,
    partition_columns,
    publish_account_summary,
    run_control,
)
from ledgerproof.schemas import BRONZE_COLUMNS
from ledgerproof.sources.fixture import bronze_fixture, event_records
from ledgerproof.session import path_exists
from ledgerproof.sources.landing import bootstrap, catalog_layers, ingest_batch, land_batch, path_layers, read_bronze

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def _landed(spark, events, scratch, *, faulty):
    layers = path_layers(scratch)
    bronze_fixture(events, faulty=faulty, keep_src=False).write.partitionBy("event_date").parquet(layers["bronze"])
    return layers


def test_bootstrap_creates_schemas_and_bronze_table(spark, tmp_path):
    tables = catalog_layers(bronze="b_t1", silver="s_t1", gold="g_t1")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS b_t1 LOCATION '{tmp_path}/b'")
    bootstrap(spark, tables)
    bootstrap(spark, tables)  # idempotent
    names = {r["namespace"] for r in spark.sql("SHOW SCHEMAS").collect()}
    assert {"b_t1", "s_t1", "g_t1"} <= names
    # partition columns come last in a table's schema; the reader restores the declared order
    assert set(spark.read.table(tables["bronze"]).columns) == set(BRONZE_COLUMNS)
    assert tuple(read_bronze(spark, tables["bronze"]).columns) == BRONZE_COLUMNS
    assert tables["bronze"] == "spark_catalog.b_t1.transactions_raw"
    assert tables["fact"] == "spark_catalog.g_t1.fct_transaction"


def test_clean_medallion_reconciles(spark, events, scratch):
    paths = _landed(spark, events, scratch, faulty=False)
    build_medallion(spark, paths)
    report = run_control(spark, paths)
    assert report.status()["passed"]


def test_injected_break_is_caught(spark, events, scratch):
    paths = _landed(spark, events, scratch, faulty=False)
    build_medallion(spark, paths, inject_break=True)
    with pytest.raises(ReconciliationFailure):
        run_control(spark, paths)
    report = run_control(spark, paths, raise_on_error=False)
    checks = {r["check"] for r in report.breaks.collect()}
    assert "amount_sum" in checks and "row_count" in checks


def test_faulty_fixture_parity_fails_but_conservation_explains(spark, events, scratch):
    paths = _landed(spark, events, scratch, faulty=True)
    build_medallion(spark, paths)
    parity = run_control(spark, paths, raise_on_error=False)
    assert not parity.status()["passed"]
    report = run_control(spark, paths, mode="conservation")
    assert report.status()["passed"]


def test_fixture_counts_match_the_documented_numbers(spark, events):
    bronze = bronze_fixture(events, faulty=True)
    assert bronze.count() == 1041
    deduped = dedup_bronze(bronze)
    assert deduped.count() == 1000
    assert dedup_bronze(bronze, null_keys="collapse").count() == 1000
    counts = {r["status"]: r["row_count"] for r in status_counts(classify(deduped)).collect()}
    assert counts == {"valid": 992, "missing_event_id": 1, "missing_currency": 3, "zero_amount": 2, "unknown": 2}


def test_null_amount_is_quarantined_not_lost(spark, events):
    silver, rejected = split_bronze(bronze_fixture(events, faulty=True)).values()
    deduped = dedup_bronze(bronze_fixture(events, faulty=True))
    assert silver.count() + rejected.count() == deduped.count()
    assert rejected.filter(F.col("signed_amount_minor").isNull()).select("rejection_reason").distinct().collect()[0][0] == "unknown"


def test_rejected_rows_are_quarantined_with_reason(spark):
    rows = [
        ("EVT-00000001", "A1", 100, 100, "GBP", "credit", "fee", datetime(2026, 9, 1), None, "s", datetime(2026, 9, 1), "b1"),
        (None, "A2", 50, 50, "GBP", "credit", "fee", datetime(2026, 9, 1), None, "s", datetime(2026, 9, 1), "b1"),
    ]
    from ledgerproof.schemas import BRONZE_SCHEMA

    bronze = spark.createDataFrame(rows, BRONZE_SCHEMA)
    silver, rejected = split_bronze(bronze).values()
    assert silver.count() == 1
    assert [r["rejection_reason"] for r in rejected.collect()] == ["missing_event_id"]


def test_land_batch_stamps_and_counts(spark, events, scratch):
    records = event_records(events).drop("_src").limit(10)
    path = f"{scratch}/landed"
    stamp = datetime(2026, 9, 1, 12, tzinfo=UTC)
    assert ingest_batch(records, path, ingested_at=stamp) == 10
    assert ingest_batch(records.limit(0), path) == 0
    landed = read_bronze(spark, path)
    assert landed.count() == 10
    row = landed.first()
    assert row["batch_id"] == "batch-20260901120000"
    assert row["ingested_at"] == datetime(2026, 9, 1, 12)
    assert tuple(landed.columns) == BRONZE_COLUMNS


def test_land_batch_signs_debits(spark):
    df = spark.createDataFrame(
        [("EVT-00000001", "A1", 500, "GBP", "debit", "fee", datetime(2026, 9, 1), "s")],
        "event_id string, account_id string, amount_minor bigint, currency string, direction string, "
        "transaction_type string, occurred_at timestamp_ntz, source_system string",
    )
    assert land_batch(df, batch_id="b").first()["signed_amount_minor"] == -500


def test_publish_and_lookup(spark, events, scratch):
    paths = _landed(spark, events, scratch, faulty=False)
    built = build_medallion(spark, paths)
    publish_account_summary(built["dim"], f"{scratch}/summary")
    summary = spark.read.parquet(f"{scratch}/summary")
    assert summary.count() == built["dim"].count()
    one = summary.filter(F.col("account_id") == "ACC-00001").collect()
    assert len(one) == 1 and set(one[0].asDict()) == {"account_id", "transaction_count", "net_amount_minor"}
    assert summary.filter(F.col("account_id") == "NOPE").count() == 0


def test_totals_of_written_layers_agree(spark, events, scratch):
    paths = _landed(spark, events, scratch, faulty=False)
    built = build_medallion(spark, paths)
    s = {r["partition_key"]: r["row_count"] for r in control_totals(built["silver"], "silver").collect()}
    g = {r["partition_key"]: r["row_count"] for r in control_totals(built["fact"], "gold").collect()}
    assert s == g and sum(s.values()) == 1000


def test_incremental_build_replaces_only_its_dates(spark, events, scratch):
    paths = _landed(spark, events, scratch, faulty=True)
    build_medallion(spark, paths)
    full = {k: sorted(map(repr, spark.read.parquet(paths[k]).collect())) for k in ("silver", "rejected", "fact", "dim")}
    dates = ["2024-01-03", "2024-01-17"]
    build_medallion(spark, paths, dates=dates)
    for k, rows in full.items():
        assert sorted(map(repr, spark.read.parquet(paths[k]).collect())) == rows, k
    bronze = spark.read.parquet(paths["bronze"]).filter(F.col("event_date").isin(
        [F.lit(d).cast("date") for d in dates]))
    plan = bronze._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [event_date" in plan
    report = run_control(spark, paths, mode="conservation", dates=dates)
    compared = {r["check"]: r["partitions_compared"] for r in report.summary.collect()}
    assert compared["conservation"] == 2 and compared["row_count"] == 2


def test_catalog_tables_end_to_end_with_incremental_rebuild(spark, events, tmp_path):
    tables = catalog_layers(bronze="b_cat", silver="s_cat", gold="g_cat")
    for schema in ("b_cat", "s_cat", "g_cat"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{tmp_path}/{schema}'")
    bootstrap(spark, tables)
    records = event_records(events).drop("_src")
    assert ingest_batch(records, tables["bronze"], batch_id="b1",
                        ingested_at=datetime(2024, 2, 1, tzinfo=UTC)) == 1000
    build_medallion(spark, tables)
    run_control(spark, tables)  # clean data: passes (raises otherwise)
    before = spark.read.table(tables["silver"]).count()
    build_medallion(spark, tables, dates=["2024-01-05"])
    assert spark.read.table(tables["silver"]).count() == before
    run_control(spark, tables, dates=["2024-01-05"])
    fact_before = sorted(map(repr, spark.read.table(tables["fact"]).collect()))
    assert compact_table(spark, tables["fact"], zorder_by=["account_id", "occurred_at"], target_partitions=2) == len(fact_before)
    assert sorted(map(repr, spark.read.table(tables["fact"]).collect())) == fact_before
    assert partition_columns(spark, tables["fact"]) == ("business_date",)
    add_column(spark, tables["dim"], "note", "STRING")
    dim = spark.read.table(tables["dim"])
    assert "note" in dim.columns and dim.filter("note IS NOT NULL").count() == 0 and dim.count() > 0


def test_incremental_build_equals_a_full_one(spark, events, scratch):
    from ledgerproof.plans.catalog import ARRIVAL_DATE, CORRECTED_DATE, _rewritten, corrected_bronze

    one, two = _landed(spark, events, f"{scratch}/one", faulty=True), _landed(spark, events, f"{scratch}/two", faulty=True)
    build_medallion(spark, one)
    emptied = "2024-01-09"
    for layers in (one, two):
        _rewritten(spark, layers["bronze"], "event_date", corrected_bronze)
        _rewritten(spark, layers["bronze"], "event_date",
                   lambda df: df.filter(F.col("event_date") != F.lit(emptied).cast("date")))
    modes = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    built = build_medallion(spark, one, dates=[CORRECTED_DATE, ARRIVAL_DATE, emptied])
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == modes
    full = build_medallion(spark, two)
    for layer in ("silver", "rejected", "fact", "days", "dim"):
        assert sorted(map(repr, built[layer].collect())) == sorted(map(repr, full[layer].collect())), layer
    assert not path_exists(spark, f"{one['silver']}/business_date={emptied}")
    assert run_control(spark, one, mode="conservation").status()["passed"]


def test_jobs_leave_no_scratch_folders(spark, events, scratch):
    import os

    from ledgerproof.session import checkpoint_root

    root = checkpoint_root(spark)
    before = set(os.listdir(root))
    paths = _landed(spark, events, scratch, faulty=False)
    build_medallion(spark, paths)
    run_control(spark, paths).discard()
    assert set(os.listdir(root)) == before


def test_damage_to_a_written_layer_is_found(spark, events, scratch):
    """The layers are compared as written: the same checks over slices of one frame would pass here."""
    from ledgerproof.plans.catalog import damaged_silver

    paths = _landed(spark, events, scratch, faulty=False)
    build_medallion(spark, paths)
    assert run_control(spark, paths, mode="conservation").status()["passed"]
    damaged_silver(spark, paths)
    found = {r["check"] for r in run_control(spark, paths, mode="conservation", raise_on_error=False).breaks.collect()}
    assert {"conservation", "deduplication", "row_count"} <= found


def test_totals_come_ordered(spark, events):
    keys = [r["partition_key"] for r in control_totals(events.selectExpr(
        "cast(event_id as string) as event_id", "ts as occurred_at", "cast(value as bigint) as signed_amount_minor").repartition(5),
        "x", ordered=True).collect()]
    assert keys == sorted(keys) and len(keys) > 20
