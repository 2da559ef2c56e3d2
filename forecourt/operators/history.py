"""Windows over the history of a fact."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import date, timedelta

from pyspark.sql import DataFrame

from forecourt.functions.dates import with_ymd
from forecourt.operators.filters import between_dates

Window = tuple[date, date]


def last_days(today: date, days: int = 30) -> Window:
    """The window used when none is given."""
    return today - timedelta(days=days), today


def month_windows(start: date, months: int) -> Iterator[Window]:
    """First and last day of consecutive months; no day belongs to two of them."""
    first = start.replace(day=1)
    for _ in range(months):
        following = (first + timedelta(days=32)).replace(day=1)
        yield first, following - timedelta(days=1)
        first = following


def reduce_fact(df: DataFrame, date_col: str, start: date, end: date) -> DataFrame:
    """Part of a fact between two days, with the date parts to partition it by."""
    return with_ymd(between_dates(df, date_col, start, end), date_col)


def months_of(window: Window) -> list[Window]:
    """The whole months that a window touches."""
    start, end = window
    return list(month_windows(start, (end.year - start.year) * 12 + end.month - start.month + 1))


def month_partitions(windows: Iterable[Window]) -> list[dict[str, int]]:
    """Partition values of months."""
    return [{"year": first.year, "month": first.month} for first, _ in windows]
