"""Codes, labels and identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt.functions.columns import ColumnLike, as_column

# Label classes of a commercial operation.
NETWORK = "Network Remuneration"
CLIENT = "Client Promotions"
UNKNOWN = "Unknown"


def promo_label(c: ColumnLike) -> Column:
    """Label inside an operation code.

    Codes starting with C or D carry a three-character head, all others a
    two-character one; the last two characters are a check suffix. A code too
    short to hold a label gives the empty string.
    """
    code = as_column(c)
    length = F.length(code)
    long_head = code.substr(F.lit(4), length - 5)
    short_head = code.substr(F.lit(3), length - 4)
    return F.when(code.substr(1, 1).isin("C", "D"), long_head).otherwise(short_head)


def zone_country(c: ColumnLike) -> Column:
    """Country part of a sales zone code."""
    return as_column(c).substr(3, 2)


def strip_pattern(c: ColumnLike, pattern: str) -> Column:
    return F.regexp_replace(as_column(c), pattern, "")


def country_from_label(c: ColumnLike) -> Column:
    """Second word of a zone label, capitalised; NULL when there is none."""
    return F.initcap(F.try_element_at(F.split(as_column(c), " "), F.lit(2)))


def or_unknown(c: ColumnLike) -> Column:
    return F.coalesce(as_column(c), F.lit(UNKNOWN))


def label(prefix: str, locale: str = "fr", fallback: bool = True, default: str = "fr") -> Column:
    """Label column of one locale, e.g. ``label_en``.

    With ``fallback`` a missing translation shows the default locale. The choice is
    made when the query is built, so only the needed columns are read.
    """
    wanted, base = F.col(f"{prefix}_{locale}"), F.col(f"{prefix}_{default}")
    return F.coalesce(wanted, base) if fallback and locale != default else wanted


def classify_heading(c: ColumnLike, network_headings: Sequence[str]) -> Column:
    """Class of an accounting heading; unknown headings count as client promotions."""
    return F.when(as_column(c).isin(list(network_headings)), NETWORK).otherwise(CLIENT)


def pseudonym(c: ColumnLike, salt: str) -> Column:
    """SHA-256 of the identifier and a salt, as hexadecimal text."""
    return F.sha2(F.concat(as_column(c).cast("string"), F.lit(salt)), 256)
