"""The bronze test fixture, derived from the given ``events`` table by column arithmetic.

The test tables have unique ids and no NULLs, so duplicate deliveries and faults are injected
as a function of ``event_id``. One scan of ``events`` produces every delivery: each row carries an
array of its deliveries, which is exploded, instead of three scans glued by ``UNION ALL``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerproof.functions.money import minor_units, signed_amount
from ledgerproof.schemas import BRONZE_COLUMNS, EVENT_FIELDS

# Fixed values of the fixture definition (FIXTURES.md section 2).
NULL_ID_MOD, NULL_ID_REM = 997, 7
ZERO_AMOUNT_MOD, ZERO_AMOUNT_REM = 499, 3
NULL_SIGNED_MOD, NULL_SIGNED_REM = 797, 2
NULL_CURRENCY_MOD, NULL_CURRENCY_REM = 401, 1
REDELIVER_LATE_MOD, REDELIVER_LATE_REM = 33, 0
REDELIVER_TIE_MOD, REDELIVER_TIE_REM = 101, 5
CURRENCY_BY_ID_MOD3 = ("GBP", "EUR", "USD")
TYPE_MAP = {
    "click": "card_payment",
    "error": "fee",
    "purchase": "transfer",
    "signup": "refund",
    "view": "fx_conversion",
}
DEBIT_EVENT_TYPES = ("purchase", "error")
SOURCE_SYSTEM = "core-ledger"


def _hit(mod: int, rem: int) -> Column:
    return (F.col("event_id") % F.lit(mod)) == F.lit(rem)


def _padded(prefix: str, column: str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(column).cast("string"), width, "0"))


def transactions_from_events(events: DataFrame, *, faulty: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """The eight event fields plus ``signed_amount_minor``, ``event_date`` and the ``_src`` sequence.

    ``occurred_at`` stays ``timestamp_ntz`` (UTC wall clock), so ``event_date`` has no zone effect.
    ``carry`` names extra input columns passed through unchanged.
    """
    event_type = F.col("event_type")
    type_expr = F.lit(None).cast("string")
    for source, target in reversed(list(TYPE_MAP.items())):
        type_expr = F.when(event_type == F.lit(source), F.lit(target)).otherwise(type_expr)
    direction = F.when(event_type.isin(*DEBIT_EVENT_TYPES), F.lit("debit")).otherwise(F.lit("credit"))
    by_three = F.col("event_id") % 3
    currency = (
        F.when(by_three == 0, F.lit(CURRENCY_BY_ID_MOD3[0]))
        .when(by_three == 1, F.lit(CURRENCY_BY_ID_MOD3[1]))
        .otherwise(F.lit(CURRENCY_BY_ID_MOD3[2]))
    )
    amount = minor_units("value")
    event_id = _padded("EVT-", "event_id", 8)
    signed = signed_amount(amount, direction)
    if faulty:
        event_id = F.when(_hit(NULL_ID_MOD, NULL_ID_REM), F.lit(None).cast("string")).otherwise(event_id)
        zero = _hit(ZERO_AMOUNT_MOD, ZERO_AMOUNT_REM)
        amount = F.when(zero, F.lit(0).cast("bigint")).otherwise(amount)
        signed = (
            F.when(_hit(NULL_SIGNED_MOD, NULL_SIGNED_REM), F.lit(None).cast("bigint"))
            .when(zero, F.lit(0).cast("bigint"))
            .otherwise(signed)
        )
        currency = F.when(_hit(NULL_CURRENCY_MOD, NULL_CURRENCY_REM), F.lit(None).cast("string")).otherwise(currency)
    return events.select(
        event_id.alias("event_id"),
        _padded("ACC-", "user_id", 5).alias("account_id"),
        amount.alias("amount_minor"),
        signed.alias("signed_amount_minor"),
        currency.alias("currency"),
        direction.alias("direction"),
        type_expr.alias("transaction_type"),
        F.col("ts").alias("occurred_at"),
        F.col("ts").cast("date").alias("event_date"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.col("event_id").alias("_src"),
        *carry,
    )


def event_records(events: DataFrame, *, faulty: bool = False) -> DataFrame:
    """Just the eight input fields of an event (what a producer sends), plus ``_src``."""
    return transactions_from_events(events, faulty=faulty).select(*EVENT_FIELDS, "_src")


def bronze_fixture(events: DataFrame, *, faulty: bool = True, keep_src: bool = True) -> DataFrame:
    """Bronze as landed: batch ``b1`` one minute after the event, late copies as ``b2`` (five minutes
    after ``b1``) and same-stamp copies as ``b3`` (a tie with ``b1`` on ``ingested_at``)."""
    deliveries = F.filter(
        F.array(
            F.struct(F.lit("b1").alias("batch_id"), F.lit(1).alias("delay")),
            F.when(
                _hit(REDELIVER_LATE_MOD, REDELIVER_LATE_REM),
                F.struct(F.lit("b2").alias("batch_id"), F.lit(6).alias("delay")),
            ),
            F.when(
                _hit(REDELIVER_TIE_MOD, REDELIVER_TIE_REM),
                F.struct(F.lit("b3").alias("batch_id"), F.lit(1).alias("delay")),
            ),
        ),
        lambda d: d.isNotNull(),
    )
    landed = transactions_from_events(
        events.select("event_id", "ts", "user_id", "event_type", "value", F.explode(deliveries).alias("_d")),
        faulty=faulty,
        carry=("_d",),
    )
    stamped = landed.select(
        "*",
        (F.col("occurred_at") + F.make_dt_interval(mins=F.col("_d.delay"))).alias("ingested_at"),
        F.col("_d.batch_id").alias("batch_id"),
    )
    cols = [*BRONZE_COLUMNS, "_src"] if keep_src else list(BRONZE_COLUMNS)
    return stamped.select(*cols)
