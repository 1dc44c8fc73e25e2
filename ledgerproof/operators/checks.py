"""Reconciliation checks as DataFrame plans.

A check turns control totals (or key sets) into an *evaluated* frame: one row per compared subject
(partition key or fact key) with the nine ``breaks`` columns and an ``is_break`` flag. ``breaks`` is
a filter of it, ``summary`` a one-row aggregate of it, so nothing is collected to compare.

Aligning two sides is a ``full_outer`` join on ``partition_key``: both sides hold one row per key
(asserted), the frames are tiny, and AQE picks a broadcast from their measured size at run time.
Referential integrity reads each side once, cuts it to distinct keys and joins those null-safely, so NULL
matches NULL. No key set is ever held on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerproof.functions.money import allowance, drift
from ledgerproof.operators.control_totals import assert_valid_totals
from ledgerproof.schemas import BREAKS_SCHEMA

BREAK_COLUMNS = [f.name for f in BREAKS_SCHEMA.fields]
ERROR, WARNING = "error", "warning"

# Break notes as the original checks emit them (reports are compared as text).
NOTE_MISSING_TARGET = "partition missing from target layer"
NOTE_MISSING_SOURCE = "partition present in target but absent from source"
NOTE_DUPLICATES = "duplicate event ids survived into this layer"
NOTE_CONSERVATION = "rows neither in the target layer nor in quarantine"


@dataclass(frozen=True)
class CheckResult:
    """A named check over an evaluated frame. ``step`` orders results inside a report."""

    check: str
    source_layer: str
    target_layer: str
    evaluated: DataFrame
    step: int = 0

    @property
    def breaks(self) -> DataFrame:
        return self.evaluated.filter(F.col("is_break")).select(*BREAK_COLUMNS)

    @property
    def tally(self) -> DataFrame:
        """One row: the summary columns and the number of breaks of either severity."""
        errors = F.count_if(F.col("is_break") & (F.col("severity") == F.lit(ERROR)))
        return self.evaluated.agg(
            F.lit(self.step).alias("step"),
            F.lit(self.check).alias("check"),
            F.lit(self.source_layer).alias("source_layer"),
            F.lit(self.target_layer).alias("target_layer"),
            (errors == 0).alias("passed"),
            F.count(F.lit(1)).alias("partitions_compared"),
            F.count_if(F.col("is_break")).alias("breaks"),
            errors.alias("errors"),
        )

    @property
    def summary(self) -> DataFrame:
        return self.tally.drop("errors")

    def at_step(self, step: int) -> "CheckResult":
        return CheckResult(self.check, self.source_layer, self.target_layer, self.evaluated, step)


def _break_row(
    check: str,
    key: Column,
    source_layer: str | Column,
    target_layer: str | Column,
    expected: Column,
    actual: Column,
    is_break: Column,
    note: Column,
    severity: str | Column = ERROR,
) -> list[Column]:
    def lit(v: str | Column) -> Column:
        return F.lit(v) if isinstance(v, str) else v

    return [
        F.lit(check).alias("check"),
        key.alias("partition_key"),
        lit(source_layer).alias("source_layer"),
        lit(target_layer).alias("target_layer"),
        expected.cast("bigint").alias("expected"),
        actual.cast("bigint").alias("actual"),
        (actual - expected).cast("bigint").alias("delta"),
        lit(severity).alias("severity"),
        note.alias("note"),
        is_break.alias("is_break"),
    ]


def align(source: DataFrame, target: DataFrame, *, validate: bool = True) -> DataFrame:
    """Union of partition keys; columns ``s_*`` / ``t_*`` plus presence flags.

    ``validate`` asserts one row per key and sane counts on both sides; pass False only for totals that
    were validated already (the suite validates its stacked totals once).
    """
    if validate:
        source, target = assert_valid_totals(source), assert_valid_totals(target)

    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select(
            "partition_key",
            F.lit(True).alias(f"{p}present"),
            F.col("row_count").alias(f"{p}rows"),
            F.col("amount_minor_sum").alias(f"{p}amount"),
            F.col("distinct_event_ids").alias(f"{p}distinct"),
        )

    return side(source, "s_").join(side(target, "t_"), "partition_key", "full_outer")


def row_count_check(
    source: DataFrame,
    target: DataFrame,
    *,
    source_layer: str = "bronze",
    target_layer: str = "silver",
    expect_distinct_source: bool = False,
    expect_distinct_target: bool = False,
    name: str = "row_count",
    validate: bool = True,
) -> CheckResult:
    """Rows (or distinct ids, per side) must match per partition; a missing side counts as zero."""
    aligned = align(source, target, validate=validate)
    expected = F.coalesce(F.col("s_distinct" if expect_distinct_source else "s_rows"), F.lit(0))
    actual = F.coalesce(F.col("t_distinct" if expect_distinct_target else "t_rows"), F.lit(0))
    note = (
        F.when(F.col("t_present").isNull(), F.lit(NOTE_MISSING_TARGET))
        .when(F.col("s_present").isNull(), F.lit(NOTE_MISSING_SOURCE))
        .otherwise(F.lit(""))
    )
    evaluated = aligned.select(
        *_break_row(name, F.col("partition_key"), source_layer, target_layer, expected, actual, expected != actual, note)
    )
    return CheckResult(name, source_layer, target_layer, evaluated)


def validate_tolerances(tolerance_minor: int, relative_tolerance: float) -> None:
    if tolerance_minor < 0:
        raise ValueError(f"an absolute tolerance cannot be below zero, got {tolerance_minor}")
    if not 0.0 <= relative_tolerance <= 0.01:
        raise ValueError(f"a relative tolerance lies between 0 and 0.01, got {relative_tolerance}")


def amount_sum_check(
    source: DataFrame,
    target: DataFrame,
    *,
    source_layer: str = "bronze",
    target_layer: str = "silver",
    tolerance_minor: int = 0,
    relative_tolerance: float = 0.0,
    name: str = "amount_sum",
    validate: bool = True,
) -> CheckResult:
    """Break when ``|actual - expected|`` exceeds the allowance, which scales on *expected* only."""
    validate_tolerances(tolerance_minor, relative_tolerance)
    aligned = align(source, target, validate=validate).select(
        "partition_key",
        F.coalesce(F.col("s_amount"), F.lit(0).cast("bigint")).alias("_expected"),
        F.coalesce(F.col("t_amount"), F.lit(0).cast("bigint")).alias("_actual"),
    )
    exp, act = F.col("_expected"), F.col("_actual")
    gap, allowed = drift(exp, act), allowance(exp, tolerance_minor, relative_tolerance)
    note = F.format_string("drift %d minor units exceeds allowance %d", gap, allowed)
    evaluated = aligned.select(
        *_break_row(name, F.col("partition_key"), source_layer, target_layer, exp, act, gap > allowed, note)
    )
    return CheckResult(name, source_layer, target_layer, evaluated)


def dedup_check(subject: DataFrame, *, layer: str = "silver", name: str = "deduplication",
                validate: bool = True) -> CheckResult:
    """Rows must equal distinct ids per partition (a NULL id counts as a row but not as an id).

    Both layer labels are the subject row's own layer. Duplicate partition keys are an error here too.
    """
    if validate:
        subject = assert_valid_totals(subject)
    evaluated = subject.select(
        *_break_row(
            name,
            F.col("partition_key"),
            F.col("layer"),
            F.col("layer"),
            F.col("distinct_event_ids"),
            F.col("row_count"),
            F.col("row_count") != F.col("distinct_event_ids"),
            F.lit(NOTE_DUPLICATES),
        )
    )
    return CheckResult(name, layer, layer, evaluated)


def dedup_check_pair(source: DataFrame, target: DataFrame, *, layer: str = "silver") -> CheckResult:
    """The two-argument form: the target's totals, or the source's when the target has none.

    Expressed with an uncorrelated ``EXISTS`` subquery, so no action runs to decide.
    """
    subjects = target.unionByName(source.filter(~target.exists()))
    return dedup_check(subjects, layer=layer)


def referential_integrity_check(
    fact: DataFrame,
    dimension: DataFrame,
    *,
    key: str = "account_id",
    dimension_key: str | None = None,
    dimension_name: str = "dim_account",
    severity: str = ERROR,
    name: str = "referential_integrity",
) -> CheckResult:
    """One break per distinct fact key with no dimension row; NULL matches NULL (set semantics)."""
    if severity not in (ERROR, WARNING):
        raise ValueError("severity must be 'error' or 'warning'")
    dim_key = dimension_key or key
    # Both sides are read once and cut to distinct keys; the null-safe join moves only those.
    fact_keys = fact.select(F.col(key).alias("_fk")).distinct()
    dim_keys = dimension.select(F.col(dim_key).alias("_dk"), F.lit(True).alias("_hit")).distinct()
    joined = fact_keys.join(dim_keys, F.col("_fk").eqNullSafe(F.col("_dk")), "left")
    label = F.concat(F.lit(f"{dimension_name}:"), F.coalesce(F.col("_fk").cast("string"), F.lit("None")))
    evaluated = joined.select(
        *_break_row(
            name,
            label,
            "gold",
            "gold",
            F.lit(1),
            F.lit(0),
            F.col("_hit").isNull(),
            F.lit(f"fact references {dimension_name} key with no dimension row"),
            severity,
        )
    )
    return CheckResult(name, "gold", "gold", evaluated)


def conservation_check(
    bronze_deduped: DataFrame,
    silver: DataFrame,
    rejected: DataFrame,
    *,
    measure: str = "rows",
    name: str | None = None,
    validate: bool = True,
) -> CheckResult:
    """Deduplicated bronze must equal silver plus quarantine, per partition (rows or amounts)."""
    if measure not in ("rows", "amount"):
        raise ValueError("measure must be 'rows' or 'amount'")
    check = name or ("conservation" if measure == "rows" else "conservation_amount")
    if validate:
        silver, rejected = assert_valid_totals(silver), assert_valid_totals(rejected)
    landed = silver.unionByName(rejected.select(*silver.columns)).groupBy("partition_key").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("amount_minor_sum").alias("amount_minor_sum"),
        F.sum("distinct_event_ids").alias("distinct_event_ids"),
    ).withColumn("layer", F.lit("silver+rejected"))
    aligned = align(bronze_deduped, landed, validate=validate)
    column = "rows" if measure == "rows" else "amount"
    expected = F.coalesce(F.col(f"s_{column}"), F.lit(0))
    actual = F.coalesce(F.col(f"t_{column}"), F.lit(0))
    evaluated = aligned.select(
        *_break_row(
            check,
            F.col("partition_key"),
            "bronze",
            "silver+rejected",
            expected,
            actual,
            expected != actual,
            F.lit(NOTE_CONSERVATION),
        )
    )
    return CheckResult(check, "bronze", "silver+rejected", evaluated)
