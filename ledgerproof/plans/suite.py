"""Which layers are compared, with which checks.

``parity`` runs exactly the six reference checks: deduplicated bronze -> silver rows and amounts,
silver -> gold rows and amounts, silver dedup, fact -> dimension integrity. ``conservation`` replaces
the bronze -> silver pair with bronze = silver + quarantine (rows and amounts), so legitimate rejects
are explained instead of failing the run.

``bronze_deduped`` lets a caller that already holds the deduplicated bronze (the build job checkpoints
it) reuse it instead of deduplicating bronze again.

The totals of all layers are tiny (one row per partition). With ``materialize=True`` they are stacked
and written once as a table in the shared folder named by ``spark.checkpoint.dir``, so the checks read
each layer's scan exactly once and a lost executor cannot force the layers to be rescanned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerproof.operators.checks import (
    amount_sum_check,
    conservation_check,
    dedup_check,
    referential_integrity_check,
    row_count_check,
)
from ledgerproof.operators.control_totals import assert_valid_totals, control_totals
from ledgerproof.operators.report import Report, run_all
from ledgerproof.session import materialize_at

MODES = ("parity", "conservation")


def layer_totals(
    bronze: DataFrame,
    silver: DataFrame,
    fact: DataFrame,
    *,
    rejected: DataFrame | None = None,
    source: DataFrame | None = None,
    bronze_deduped: DataFrame | None = None,
    date_col: str = "business_date",
) -> dict[str, DataFrame]:
    deduped_totals = (
        control_totals(bronze_deduped, "bronze", partition_col=date_col, key_unique=True)
        if bronze_deduped is not None
        else control_totals(bronze, "bronze", partition_col=date_col, dedupe=True)
    )
    totals = {
        "bronze": deduped_totals,
        "silver": control_totals(silver, "silver", partition_col=date_col),
        # no suite check reads the distinct count of gold or of the quarantine: skip that shuffle
        "gold": control_totals(fact, "gold", partition_col=date_col, with_distinct=False),
    }
    if rejected is not None:
        totals["rejected"] = control_totals(rejected, "rejected", partition_col=date_col, with_distinct=False)
    if source is not None:
        totals["source"] = source
        totals["bronze_raw"] = control_totals(bronze, "bronze", partition_col=date_col).withColumn(
            "layer", F.lit("bronze_raw")
        )
    return totals


def _materialized(totals: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], str]:
    """The stacked totals, validated and written; and their folder."""
    frames = [df.withColumn("_slot", F.lit(name)) for name, df in totals.items()]
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f)
    stacked, path = materialize_at(assert_valid_totals(stacked), "control-totals")
    return {name: stacked.filter(F.col("_slot") == F.lit(name)).drop("_slot") for name in totals}, path


def reconciliation_suite(
    bronze: DataFrame,
    silver: DataFrame,
    fact: DataFrame,
    dim: DataFrame,
    *,
    rejected: DataFrame | None = None,
    source: DataFrame | None = None,
    bronze_deduped: DataFrame | None = None,
    mode: str = "parity",
    tolerance_minor: int = 0,
    relative_tolerance: float = 0.0,
    date_col: str = "business_date",
    materialize: bool = False,
) -> Report:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "conservation" and rejected is None:
        raise ValueError("conservation mode needs the rejected (quarantine) table")
    totals = layer_totals(
        bronze, silver, fact, rejected=rejected, source=source, bronze_deduped=bronze_deduped, date_col=date_col
    )
    scratch = []
    if materialize:
        totals, path = _materialized(totals)
        scratch = [path]
    # materialized totals were validated once when written; otherwise each check validates its inputs
    tol = {"tolerance_minor": tolerance_minor, "relative_tolerance": relative_tolerance, "validate": not materialize}
    v = {"validate": not materialize}
    b, s, g = totals["bronze"], totals["silver"], totals["gold"]
    checks = []
    if source is not None:
        checks += [
            row_count_check(
                totals["source"], totals["bronze_raw"], source_layer="source", target_layer="bronze",
                expect_distinct_target=True, **v,
            ),
            amount_sum_check(totals["source"], b, source_layer="source", target_layer="bronze", **tol),
        ]
    if mode == "parity":
        checks += [row_count_check(b, s, **v), amount_sum_check(b, s, **tol)]
    else:
        r = totals["rejected"]
        checks += [
            conservation_check(b, s, r, measure="rows", **v),
            conservation_check(b, s, r, measure="amount", **v),
        ]
    checks += [
        row_count_check(s, g, source_layer="silver", target_layer="gold", **v),
        amount_sum_check(s, g, source_layer="silver", target_layer="gold", **tol),
        dedup_check(s, **v),
        referential_integrity_check(fact, dim, key="account_id", dimension_name="dim_account"),
    ]
    report = run_all(checks)
    report.scratch = scratch
    return report
