"""Row filters, written so that they reach the parquet scan."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bound(df: DataFrame, c: str, day: date) -> Column:
    """Midnight of a day in the type of the column, so that no cast hides the column."""
    return F.lit(day).cast(df.schema[c].dataType)


def from_day(df: DataFrame, c: str, start: date) -> Column:
    return F.col(c) >= _bound(df, c, start)


def before_day(df: DataFrame, c: str, end: date) -> Column:
    return F.col(c) < _bound(df, c, end)


def between_dates(df: DataFrame, c: str, start: date, end: date) -> DataFrame:
    """Days from ``start`` to ``end``, both included, also for a timestamp column."""
    return df.filter(from_day(df, c, start) & before_day(df, c, end + timedelta(days=1)))


def keep_in(df: DataFrame, c: str, values: Iterable[object]) -> DataFrame:
    return df.filter(F.col(c).isin(list(values)))


def restrict(
    df: DataFrame,
    country: str | None = None,
    brand: str | None = None,
    country_column: str = "country",
    brand_column: str = "brand",
) -> DataFrame:
    """Keep one country, one brand, or one brand in one country."""
    if country is not None:
        df = df.filter(F.col(country_column) == country)
    if brand is not None:
        df = df.filter(F.col(brand_column) == brand)
    return df


def drop_blank(df: DataFrame, c: str) -> DataFrame:
    """Drop rows whose identifier is missing or consists of blanks."""
    return df.filter(F.trim(c) != "")


def nonzero(df: DataFrame, c: str) -> DataFrame:
    """Drop zero and missing amounts."""
    return df.filter(F.col(c) != 0)


def perimeter(
    df: DataFrame,
    sites: Sequence[str],
    start: date,
    end: date,
    door: str,
    site_column: str = "site",
    date_column: str = "pass_date",
    door_column: str = "door",
) -> DataFrame:
    """Passages of some sites through one door, from ``start`` to the day before ``end``."""
    return df.filter(
        F.col(site_column).isin(list(sites))
        & from_day(df, date_column, start)
        & before_day(df, date_column, end)
        & (F.col(door_column) == door)
    )
