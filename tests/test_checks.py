"""Reconciliation checks over hand-made control totals (the reference's pinned unit cases)."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from ledgerproof.operators import checks as C
from ledgerproof.operators.report import ReconciliationFailure, run_all

from ledgerproof.session import path_exists

from .conftest import total, totals


def test_distinct_cannot_exceed_rows(spark):
    bad = totals(spark, [total("bronze", "2026-09-01", 5, 0, 6)])
    good = totals(spark, [total("silver", "2026-09-01", 5, 0)])
    with pytest.raises(PySparkException, match="invalid control total"):
        C.row_count_check(bad, good).breaks.collect()


def test_duplicate_partition_key_is_an_error(spark):
    dup = totals(spark, [total("bronze", "d", 1, 0), total("bronze", "d", 2, 0)])
    other = totals(spark, [total("silver", "d", 3, 0)])
    with pytest.raises(PySparkException, match="duplicate control total"):
        C.row_count_check(dup, other).breaks.collect()


def test_matching_counts_pass(spark):
    src = totals(spark, [total("bronze", "2026-09-01", 100, 5000)])
    tgt = totals(spark, [total("silver", "2026-09-01", 100, 5000)])
    assert C.row_count_check(src, tgt).summary.first()["passed"]


def test_missing_partition_is_caught(spark):
    src = totals(spark, [total("bronze", "2026-09-01", 10, 1), total("bronze", "2026-09-02", 10, 1)])
    tgt = totals(spark, [total("silver", "2026-09-01", 10, 1)])
    result = C.row_count_check(src, tgt)
    breaks = result.breaks.collect()
    assert not result.summary.first()["passed"]
    assert [b["partition_key"] for b in breaks] == ["2026-09-02"]
    assert breaks[0]["note"] == "partition missing from target layer"
    assert (breaks[0]["expected"], breaks[0]["actual"], breaks[0]["delta"]) == (10, 0, -10)


def test_partition_only_in_target_is_noted(spark):
    src = totals(spark, [total("bronze", "a", 1, 1)])
    tgt = totals(spark, [total("silver", "a", 1, 1), total("silver", "b", 2, 1)])
    (b,) = C.row_count_check(src, tgt).breaks.collect()
    assert b["note"] == "partition present in target but absent from source"


def test_distinct_target_mode_tolerates_bronze_duplicates(spark):
    source = totals(spark, [total("source", "2026-09-01", 100, 5000)])
    bronze = totals(spark, [total("bronze", "2026-09-01", 112, 5600, 100)])
    check = C.row_count_check(source, bronze, source_layer="source", target_layer="bronze", expect_distinct_target=True)
    assert check.summary.first()["passed"]
    # only the row check tolerates duplicates: the raw bronze amount still includes them
    assert not C.amount_sum_check(source, bronze).summary.first()["passed"]


def test_amount_tolerance_scales_with_relative(spark):
    src = totals(spark, [total("silver", "2026-09-01", 10, 1_000_000)])
    tgt = totals(spark, [total("gold", "2026-09-01", 10, 1_000_500)])
    assert C.amount_sum_check(src, tgt, relative_tolerance=0.001).summary.first()["passed"]
    assert not C.amount_sum_check(src, tgt, relative_tolerance=0.0004).summary.first()["passed"]
    assert C.amount_sum_check(src, tgt, tolerance_minor=500).summary.first()["passed"]


def test_allowance_truncates(spark):
    # |expected| * rel = 1999 * 0.001 = 1.999 -> allowance 1, so a drift of 2 breaks
    src = totals(spark, [total("silver", "d", 1, 1999)])
    tgt = totals(spark, [total("gold", "d", 1, 2001)])
    (b,) = C.amount_sum_check(src, tgt, relative_tolerance=0.001).breaks.collect()
    assert b["note"] == "drift 2 minor units exceeds allowance 1"


def test_tolerance_arguments_are_validated():
    with pytest.raises(ValueError):
        C.validate_tolerances(-1, 0.0)
    with pytest.raises(ValueError):
        C.validate_tolerances(0, 0.02)


def test_offsetting_errors_dont_cancel_across_partitions(spark):
    src = totals(spark, [total("silver", "2026-09-01", 5, 1000), total("silver", "2026-09-02", 5, 1000)])
    tgt = totals(spark, [total("gold", "2026-09-01", 5, 1500), total("gold", "2026-09-02", 5, 500)])
    assert C.amount_sum_check(src, tgt).breaks.count() == 2


def test_deduplication_check_catches_survivors(spark):
    silver = totals(spark, [total("silver", "2026-09-01", 105, 1000, 100)])
    result = C.dedup_check(silver)
    (b,) = result.breaks.collect()
    assert b["delta"] == 5 and b["source_layer"] == b["target_layer"] == "silver"
    assert not result.summary.first()["passed"]


def test_dedup_pair_falls_back_to_source_when_target_empty(spark):
    src = totals(spark, [total("bronze", "d", 3, 0, 2)])
    empty = totals(spark, [])
    assert C.dedup_check_pair(src, empty).breaks.count() == 1
    tgt = totals(spark, [total("silver", "d", 2, 0, 2)])
    assert C.dedup_check_pair(src, tgt).breaks.count() == 0


def test_referential_integrity_reports_orphans_individually(spark):
    fact = spark.createDataFrame([("A",), ("B",), ("C",), ("B",)], "account_id string")
    dim = spark.createDataFrame([("A",)], "account_id string")
    result = C.referential_integrity_check(fact, dim)
    assert {b["partition_key"] for b in result.breaks.collect()} == {"dim_account:B", "dim_account:C"}
    s = result.summary.first()
    assert (s["partitions_compared"], s["breaks"], s["passed"]) == (3, 2, False)


def test_referential_integrity_null_safe_and_warning(spark):
    fact = spark.createDataFrame([("A",), (None,)], "account_id string")
    dim = spark.createDataFrame([("A",), (None,)], "account_id string")
    assert C.referential_integrity_check(fact, dim).breaks.count() == 0
    dim_no_null = spark.createDataFrame([("A",)], "account_id string")
    result = C.referential_integrity_check(fact, dim_no_null, severity="warning")
    (b,) = result.breaks.collect()
    assert b["partition_key"] == "dim_account:None" and b["severity"] == "warning"
    assert result.summary.first()["passed"]  # warnings do not fail


def test_report_raises_on_error(spark):
    src = totals(spark, [total("bronze", "d", 10, 1)])
    tgt = totals(spark, [total("silver", "d", 9, 1)])
    report = run_all([C.row_count_check(src, tgt)])
    with pytest.raises(ReconciliationFailure, match="reconciliation FAILED: 1 error"):
        report.raise_for_status()
    lines = [r["line"] for r in report.lines().orderBy("step", "partition_key").collect()]
    assert lines == ["reconciliation FAILED: 1 error(s), 0 warning(s)", "  [ERROR] row_count @ d: bronze=10 vs silver=9 (delta -1)"]


def test_report_passes_and_lists_checks(spark):
    src = totals(spark, [total("bronze", "d", 10, 1)])
    report = run_all([C.row_count_check(src, src), C.amount_sum_check(src, src)])
    report.raise_for_status()
    st = report.status()
    assert st["text"] == "reconciliation PASSED (2 checks: row_count, amount_sum)"
    assert st["passed"] and [c["step"] for c in st["checks"]] == [1, 2]


def test_warnings_only_pass_with_warnings(spark):
    fact = spark.createDataFrame([("A",), ("B",)], "account_id string")
    dim = spark.createDataFrame([("A",)], "account_id string")
    report = run_all([C.referential_integrity_check(fact, dim, severity="warning")])
    assert report.status()["text"] == "reconciliation PASSED with warnings: 0 error(s), 1 warning(s)"


def test_reconcile_runs_several_checks_on_one_pair(spark):
    from functools import partial

    from ledgerproof.operators.report import reconcile

    src = totals(spark, [total("silver", "d", 10, 1_000_000)])
    tgt = totals(spark, [total("gold", "d", 10, 1_000_500)])
    amount = partial(C.amount_sum_check, source_layer="silver", target_layer="gold", relative_tolerance=0.001)
    rows = partial(C.row_count_check, source_layer="silver", target_layer="gold")
    report = reconcile([rows, amount], src, tgt)
    assert [(r["step"], r["check"], r["passed"]) for r in report.summary.orderBy("step").collect()] == [
        (1, "row_count", True), (2, "amount_sum", True)
    ]


def test_dedup_check_rejects_duplicate_partition_keys(spark):
    dup = totals(spark, [total("silver", "d", 2, 0, 2), total("silver", "d", 3, 0, 3)])
    with pytest.raises(PySparkException, match="duplicate control total"):
        C.dedup_check(dup).breaks.collect()


def test_report_write_and_run_verdict(spark, tmp_path):
    from ledgerproof.operators.report import run_summary

    src = totals(spark, [total("bronze", "d", 10, 1), total("bronze", "e", 5, 1)])
    tgt = totals(spark, [total("silver", "d", 9, 1), total("silver", "e", 5, 1)])
    report = run_all([C.row_count_check(src, tgt), C.amount_sum_check(src, tgt)])
    report.write(str(tmp_path / "report"))
    written = spark.read.json(str(tmp_path / "report" / "records")).filter("record = 'break'").collect()
    assert [(r["check"], r["partition_key"], r["delta"]) for r in written] == [("row_count", "d", -1)]
    verdict = run_summary(report.summary).first()
    assert (verdict["passed"], verdict["checks"], verdict["breaks"]) == (False, 2, 1)
    kept = report.materialize()
    assert kept.status() == report.status()
    (folder,) = kept.scratch
    assert path_exists(spark, folder)
    kept.discard()
    assert not path_exists(spark, folder)


def test_thousands_of_breaks_come_out_whole(spark, tmp_path):
    fact = spark.range(3000).selectExpr("cast(id as string) as account_id")
    dim = spark.createDataFrame([("7",)], "account_id string")
    report = run_all([C.referential_integrity_check(fact, dim)])
    path = str(tmp_path / "report")
    with pytest.raises(ReconciliationFailure, match="2999 error.*all breaks are in " + path):
        report.raise_for_status(path)
    assert spark.read.json(f"{path}/records").filter("record = 'break'").count() == 2999
    assert spark.read.text(f"{path}/text").count() == 3000
    keys = [r["partition_key"] for r in report.ordered_breaks().collect()]
    assert keys == sorted(keys) and len(set(keys)) == 2999


def test_integrity_reads_each_side_once(spark, tmp_path):
    for name in ("fact", "dim"):
        spark.range(20).selectExpr("cast(id as string) as account_id").write.parquet(str(tmp_path / name))
    fact, dim = (spark.read.parquet(str(tmp_path / n)) for n in ("fact", "dim"))
    plan = C.referential_integrity_check(fact, dim).breaks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
