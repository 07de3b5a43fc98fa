"""Column helpers that reproduce the NULL rules of the source data frames.

The source language differs from SQL in a handful of places (membership
tests are never unknown, joins match missing to missing, trimming strips all
whitespace, ...).  Each helper returns a native Column so the expressions
stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace class stripped by the source's trim functions.
_TRIM_PATTERN = r"^\s+|\s+$"

# Money and amount types (decide once, used everywhere).
MONEY = "decimal(18,2)"
AMOUNT = "decimal(18,6)"
WIDE_AMOUNT = "decimal(28,6)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: str | Column) -> Column:
    """Strip leading/trailing whitespace of any kind (Spark ``trim`` strips spaces only)."""
    return F.regexp_replace(col(c), _TRIM_PATTERN, "")


def blank_to_null(c: str | Column) -> Column:
    """Trimmed text, with empty text turned into NULL."""
    t = trim_ws(c)
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def is_in(c: str | Column, values: Iterable) -> Column:
    """``x %in% set``: never NULL, FALSE for a missing value."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def not_in(c: str | Column, values: Iterable) -> Column:
    """``!x %in% set``: keeps rows whose value is missing."""
    return ~is_in(c, values)


def true_or_false(cond: Column) -> Column:
    """A predicate where unknown counts as FALSE (the source's ``filter``)."""
    return F.coalesce(cond, F.lit(False))


def parse_currency(c: str | Column) -> Column:
    """Keep only digits and dots, then parse (``£1,234.50`` -> 1234.50).

    Minus signs and brackets are dropped like the source does; text with two
    dots or nothing left parses to NULL.
    """
    return F.regexp_replace(col(c), r"[^0-9.]", "").try_cast("double")


def round_even(c: str | Column, scale: int) -> Column:
    """Half-to-even rounding on an exact decimal value."""
    return F.bround(col(c), scale)
