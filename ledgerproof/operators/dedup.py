"""First-arrival-wins deduplication.

Plan shape: ``row_number() = 1`` over the key, which Catalyst turns into a *partial*
``WindowGroupLimit`` before the shuffle and a final one after it. So a key redelivered a billion times
sends at most one row per map task across the network: the hot-key case is pre-aggregated before it
is shuffled.

Rows with a NULL key are never merged (they are distinct events whose id is missing). Each gets a number of its own
as one more key of the same window, so the input is read (or computed) once and NULL keys, however many, are spread.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "_rn"
_LONE = "_lone"


def _cols(names: str | Column | Sequence[str | Column]) -> list[Column]:
    if isinstance(names, (str, Column)):
        names = [names]
    return [F.col(n) if isinstance(n, str) else n for n in names]


def first_arrival(
    df: DataFrame,
    key: str | Sequence[str] = "event_id",
    order_by: str | Column | Sequence[str | Column] = ("ingested_at",),
    *,
    null_keys: str = "keep",
) -> DataFrame:
    """Keep the first row per ``key`` under ``order_by`` (ascending, NULLs last).

    ``order_by`` should be a total order (append a delivery sequence) so the winner is deterministic.
    ``null_keys``: ``"keep"`` keeps every row whose key has a NULL part; ``"collapse"`` treats all
    NULL-keyed rows as one key, which is the legacy behaviour of a plain window over the key.
    """
    if null_keys not in ("keep", "collapse"):
        raise ValueError("null_keys must be 'keep' or 'collapse'")
    keys = _cols(key)
    order = [c.asc_nulls_last() for c in _cols(order_by)]
    if null_keys == "keep":
        any_null = reduce(lambda a, b: a | b, [k.isNull() for k in keys])
        df = df.withColumn(_LONE, F.when(any_null, F.monotonically_increasing_id()))
        keys.append(F.col(_LONE))
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) == 1).drop(_RN, _LONE)


TIE_BREAKS = ("batch_id", "_src")


def dedup_bronze(bronze: DataFrame, *, key_column: str = "event_id", order_by: str = "ingested_at",
                 null_keys: str = "keep") -> DataFrame:
    """Bronze dedup by first arrival, ties broken by ``batch_id`` then the ``_src`` sequence when present."""
    order = [order_by] + [c for c in TIE_BREAKS if c in bronze.columns and c != order_by]
    return first_arrival(bronze, key_column, order, null_keys=null_keys)
