"""Money and tolerance expressions. Amounts are integer minor units, so every comparison is exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def signed_amount(amount: str | Column = "amount_minor", direction: str | Column = "direction") -> Column:
    """Minus the magnitude for a debit, plus the magnitude otherwise (NULL stays NULL)."""
    magnitude = F.abs(_col(amount))
    return F.when(_col(direction) == F.lit("debit"), -magnitude).otherwise(magnitude)


def amount_major(amount: str | Column = "signed_amount_minor") -> Column:
    """Exact major-unit view: shift the scale by -2, no floating point."""
    return (_col(amount).cast("decimal(20,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(22,2)")


def allowance(expected: str | Column, tolerance_minor: int, relative_tolerance: float) -> Column:
    """``max(tolerance_minor, trunc(|expected| * relative_tolerance))``; the cast truncates toward zero."""
    scaled = (F.abs(_col(expected)) * F.lit(float(relative_tolerance))).cast("bigint")
    return F.greatest(F.lit(int(tolerance_minor)).cast("bigint"), scaled)


def drift(expected: str | Column, actual: str | Column) -> Column:
    return F.abs(_col(actual) - _col(expected))


def signed_text(value: str | Column) -> Column:
    """``+5`` / ``-1`` / ``+0``."""
    return F.format_string("%+d", _col(value))


def minor_units(value: str | Column) -> Column:
    """A double major-unit value as BIGINT minor units (half away from zero, as the fixture defines)."""
    return F.round(_col(value) * F.lit(100)).cast("bigint")
