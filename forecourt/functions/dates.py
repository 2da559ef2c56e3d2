"""Dates that arrive as text, and the parts of a date."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.columns import ColumnLike, as_column

# The date layouts that occur in the offer extracts, tried in this order.
OFFER_DATE_FORMATS = ("yyyy-MM-dd", "yyyy MM dd", "dd/MM/yyyy")


def parse_date(c: ColumnLike, formats: Sequence[str] = OFFER_DATE_FORMATS) -> Column:
    """First format that fits; NULL when none does.

    The shape of the text is tested first: parsing text in the wrong format raises
    and catches an exception for every row.
    """
    text = as_column(c)
    return F.coalesce(*(F.when(text.rlike(_shape(f)), F.try_to_date(text, f)) for f in formats))


def _shape(date_format: str) -> str:
    """Regular expression for digits where the format has letters."""
    return "^" + re.sub("[yMd]", r"\\d", re.escape(date_format)) + "$"


def with_ymd(df: DataFrame, c: str) -> DataFrame:
    """Add ``year``, ``month`` and ``day`` of a date column."""
    return df.withColumns({"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)})


def cycle_year(cycle: ColumnLike) -> Column:
    """A planning cycle ends with its four-digit year."""
    return F.right(as_column(cycle), F.lit(4)).try_cast("int")


def cycle_month(cycle: ColumnLike, month: ColumnLike) -> Column:
    """First day of the given month in the year of the planning cycle."""
    year = F.right(as_column(cycle), F.lit(4))
    month_text = F.lpad(as_column(month).cast("string"), 2, "0")
    return F.try_to_date(F.concat(year, F.lit("-"), month_text, F.lit("-01")), "yyyy-MM-dd")


def vehicle_age(order_date: ColumnLike, production_date: ColumnLike) -> Column:
    """Days from production to order; negative when ordered before it was built."""
    return F.datediff(as_column(order_date), as_column(production_date))


def stock_age(age: ColumnLike) -> Column:
    return F.when(as_column(age) > 0, as_column(age))


def delivery_days(order_date: ColumnLike, sale_date: ColumnLike) -> Column:
    return F.datediff(as_column(sale_date), as_column(order_date))


def age_bucket(age: ColumnLike) -> Column:
    """Label of the stock age class; day 180 still belongs to the fourth class."""
    days = as_column(age)
    return (
        F.when(days < 0, "< 0")
        .when(days < 30, "[0;30[")
        .when(days < 90, "[30;90[")
        .when(days <= 180, "[90;180[")
        .when(days > 180, ">= 180")
    )
