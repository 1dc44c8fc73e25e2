"""Time expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def utc_wall_clock(instant: str | Column) -> Column:
    """A zone-aware ``timestamp`` as ``timestamp_ntz`` holding its UTC wall clock (zone independent)."""
    col = F.col(instant) if isinstance(instant, str) else instant
    return F.timestamp_add("MICROSECOND", F.unix_micros(col), F.expr(EPOCH_NTZ))
