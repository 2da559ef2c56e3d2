"""Amounts and rates that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt.functions.columns import ColumnLike, as_column


def amount(c: ColumnLike, to: str = "double") -> Column:
    """Parse text such as ``1 234,56 EUR``.

    ``0`` means "not filled in" and becomes NULL, a decimal comma becomes a point,
    everything but digits, sign and point is removed. What still is no number
    becomes NULL.
    """
    text = F.nullif(as_column(c), F.lit("0"))
    text = F.regexp_replace(F.translate(text, ",", "."), r"[^0-9\-.]", "")
    return text.try_cast(to)


def rate(c: ColumnLike, to: str = "double") -> Column:
    """Parse a rate such as ``0,20``: blanks are removed, the comma becomes a point."""
    return F.translate(as_column(c), ", ", ".").try_cast(to)


def zero_to_null(c: ColumnLike) -> Column:
    """A total of zero means that nothing was booked."""
    column = as_column(c)
    return F.when(column != 0, column)
