"""Validation rules as column expressions: one boolean per rule, so the set of failed rules is data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerproof.schemas import DIRECTIONS, TRANSACTION_TYPES

# Whitespace as Python's str.strip() sees it, beyond ASCII too (Spark's trim() strips spaces only).
_SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_EDGE_SPACE = rf"^{_SPACE}+|{_SPACE}+\z"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(value: str | Column) -> Column:
    return F.regexp_replace(_col(value), _EDGE_SPACE, "")


def normalised_currency(value: str | Column = "currency") -> Column:
    """Trimmed and upper-cased currency code."""
    return F.upper(strip(value))


THREE_LETTERS = r"^\p{L}{3}$"


def min_length(value: str | Column, n: int) -> Column:
    return F.length(_col(value)) >= F.lit(n)


def is_direction(value: str | Column) -> Column:
    return _col(value).isin(*DIRECTIONS)


def is_transaction_type(value: str | Column) -> Column:
    return _col(value).isin(*TRANSACTION_TYPES)


def two_valued(predicate: Column) -> Column:
    """A predicate that is never NULL: unknown counts as false, so ``p`` and ``~p`` split every row."""
    return F.coalesce(predicate, F.lit(False))


def failed_rule_list(rules: dict[str, Column]) -> Column:
    """Comma-separated names of the rules whose predicate is not true ('' when all hold).

    ``concat_ws`` skips NULLs, so this stays a plain codegen'd expression (no lambda).
    """
    return F.concat_ws(",", *[F.when(two_valued(pred), F.lit(None)).otherwise(F.lit(name)) for name, pred in rules.items()])
