"""A reconciliation report: the union of check results as DataFrames, whole at any size.

The driver holds one row per check. Breaks stay frames: as rows (``breaks``), as text (``lines``) and as one
machine-readable table (``records``), written with ``write``; a failure names the folder that holds them all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerproof.operators.checks import CheckResult
from ledgerproof.session import materialize_at, remove_path


class ReconciliationFailure(RuntimeError):
    """Raised when a report holds at least one ERROR break."""


def description() -> Column:
    """One break as text; the format is a fixed value."""
    note = F.when(F.coalesce(F.col("note"), F.lit("")) != "", F.format_string(" (%s)", F.col("note"))).otherwise("")
    return F.format_string(
        "[%s] %s @ %s: %s=%d vs %s=%d (delta %+d)%s", F.upper("severity"), F.col("check"), F.col("partition_key"),
        F.col("source_layer"), F.col("expected"), F.col("target_layer"), F.col("actual"), F.col("delta"), note)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def headline(errors: int, warnings: int, names: Sequence[str]) -> str:
    """First line of a report's text; the wording is a fixed value."""
    if not errors and not warnings:
        return f"reconciliation PASSED ({len(names)} checks: {', '.join(names) or 'none'})"
    verdict = "FAILED" if errors else "PASSED with warnings"
    return f"reconciliation {verdict}: {errors} error(s), {warnings} warning(s)"


@dataclass
class Report:
    results: list[CheckResult] = field(default_factory=list)
    scratch: list[str] = field(default_factory=list)  # folders this report reads, for ``discard``

    def extend(self, more: Sequence[CheckResult]) -> "Report":
        start = len(self.results)
        self.results.extend(r.at_step(start + i + 1) for i, r in enumerate(more))
        return self

    @property
    def breaks(self) -> DataFrame:
        return _union([r.breaks for r in self.results])

    @property
    def summary(self) -> DataFrame:
        return _union([r.summary for r in self.results])

    def _stepped(self) -> DataFrame:
        return _union([r.breaks.withColumn("step", F.lit(r.step)) for r in self.results])

    def ordered_breaks(self) -> DataFrame:
        """Breaks in report order: by check, then partition key."""
        return self._stepped().orderBy("step", "partition_key").drop("step")

    def break_descriptions(self, *, ordered: bool = False) -> DataFrame:
        return (self.ordered_breaks() if ordered else self.breaks).withColumn("description", description())

    def records(self) -> DataFrame:
        """The machine-readable report, whole: one ``check`` record per check and one ``break`` record per break."""
        checks = self.summary.select(F.lit("check").alias("record"), "*")
        breaks = self._stepped().select(F.lit("break").alias("record"), "*")
        return checks.unionByName(breaks, allowMissingColumns=True)

    def lines(self) -> DataFrame:
        """The text, whole: ``step`` 0 is the headline, then a line per break; order by step, partition_key."""
        st = self.status()
        spark = self.results[0].evaluated.sparkSession
        head = spark.range(1).select(F.lit(0).alias("step"), F.lit("").alias("partition_key"), F.lit(st["text"]).alias("line"))
        body = self._stepped().select("step", "partition_key", F.concat(F.lit("  "), description()).alias("line"))
        return head.unionByName(body)

    def status(self) -> dict[str, object]:
        """One small action: a row per check."""
        rows = [r.asDict() for r in _union([r.tally for r in self.results]).orderBy("step").collect()] if self.results else []
        errors = sum(r.pop("errors") for r in rows)
        warnings = sum(r["breaks"] for r in rows) - errors
        return {"passed": errors == 0, "errors": errors, "warnings": warnings, "checks": rows,
                "text": headline(errors, warnings, [r["check"] for r in rows])}

    def write(self, path: str, *, fmt: str = "json") -> None:
        """``records`` and ``lines`` written whole under ``path``."""
        self.records().write.mode("overwrite").format(fmt).save(f"{path}/records")
        self.lines().orderBy("step", "partition_key").select("line").write.mode("overwrite").text(f"{path}/text")

    def materialize(self) -> "Report":
        """Evaluate every check once into a table in the shared checkpoint folder; the returned report's summary,
        breaks and text all read that table. ``discard`` deletes it."""
        frames = [r.evaluated.withColumn("_step", F.lit(r.step)) for r in self.results]
        stacked, path = materialize_at(_union(frames), "report")
        kept = [CheckResult(r.check, r.source_layer, r.target_layer,
                            stacked.filter(F.col("_step") == F.lit(r.step)).drop("_step"), r.step) for r in self.results]
        return Report(kept, [path])

    def discard(self) -> None:
        """Delete the folders this report reads; its frames must not be used afterwards."""
        spark = self.results[0].evaluated.sparkSession
        while self.scratch:
            remove_path(spark, self.scratch.pop())

    def raise_for_status(self, path: str | None = None) -> dict[str, object]:
        """The status; an ERROR break raises, with the report written to ``path`` first if one is given."""
        st = self.status()
        if not st["passed"]:
            if path:
                self.write(path)
            raise ReconciliationFailure(f"{st['text']}" + (f"; all breaks are in {path}" if path else ""))
        return st


def run_all(checks: Sequence[CheckResult]) -> Report:
    """Several evaluated checks as one report, in order."""
    return Report().extend(list(checks))


# A check is any callable ``(source_totals, target_totals) -> CheckResult``; parameters are bound with
# ``functools.partial`` (e.g. ``partial(amount_sum_check, tolerance_minor=5)``).
Check = Callable[[DataFrame, DataFrame], CheckResult]


def reconcile(checks: Sequence[Check], source: DataFrame, target: DataFrame) -> Report:
    """Run several checks on one pair of control totals, as one report."""
    return run_all([check(source, target) for check in checks])


def run_summary(summary: DataFrame) -> DataFrame:
    """The run verdict as one row: passed when every check passed."""
    return summary.agg(
        F.bool_and("passed").alias("passed"),
        F.count(F.lit(1)).alias("checks"),
        F.sum("breaks").alias("breaks"),
    )
