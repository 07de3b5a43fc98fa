"""Text functions: visit numbering, key formatting, sheet-name sanitising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions.nulls import col

# Characters a spreadsheet sheet name may not hold, and its
# maximum length.
ILLEGAL_SHEET_CHARS = r"[\[\]\*\?:/\\]"
MAX_SHEET_NAME = 31


def visit_number(pos1: str | Column) -> Column:
    """1-based visit position -> ``VISIT - 001`` (never truncates past 999)."""
    return F.format_string("VISIT - %03d", col(pos1).cast("int"))


def edge_key(n: str | Column) -> Column:
    """Sequence number -> ``EDGE-0001``; padding widens, never truncates."""
    return F.format_string("EDGE-%04d", col(n).cast("long"))


def sheet_safe(c: str | Column) -> Column:
    """Replace the seven illegal characters by ``_`` and cut to 31 characters."""
    return F.substring(F.regexp_replace(col(c), ILLEGAL_SHEET_CHARS, "_"), 1, MAX_SHEET_NAME)


def dots_to_spaces(c: str | Column) -> Column:
    return F.regexp_replace(col(c), r"\.", " ")
