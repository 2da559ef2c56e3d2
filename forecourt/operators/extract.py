"""Extracts described by tables, keys, conditions and a look-back period."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.operators.filters import from_day


def extract(
    df: DataFrame,
    joins: Sequence[tuple[DataFrame, str]] = (),
    columns: Sequence[str] | None = None,
    conditions: Mapping[str, Iterable[object]] | None = None,
    negate: bool = False,
    date_col: str | None = None,
    since: date | None = None,
    nb_days: int = 0,
) -> DataFrame:
    """Base table, a chain of left joins, conditions, columns.

    Each table of the chain is matched with the one before it, on the key both
    share. ``conditions`` lists the values a column must have, or must not have
    with ``negate``. Rows older than ``since`` minus ``nb_days`` are left out.
    Without ``columns`` nothing is joined. A column of a joined table that exists
    already is an error.
    """
    joined = _chain(df, joins) if columns else df
    if date_col is not None and since is not None:
        joined = joined.filter(from_day(joined, date_col, since - timedelta(days=nb_days)))
    for name, values in (conditions or {}).items():
        member = F.col(name).isin(list(values))
        joined = joined.filter(~member if negate else member)
    return joined.select(*columns) if columns else joined


def _chain(df: DataFrame, joins: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Left joins in which every link leads from one table to the next."""
    if not joins:
        return df
    joined = df.withColumn("__link_0", F.col(joins[0][1]))
    for i, (frame, key) in enumerate(joins):
        new = [c for c in frame.columns if c != key]
        clash = sorted(set(new) & set(joined.columns))
        if clash:
            raise ValueError(f"already present: {', '.join(clash)}; rename or leave out")
        right = frame.select(F.col(key).alias("__key"), *new)
        if i + 1 < len(joins):
            right = frame.select(
                F.col(key).alias("__key"), *new, F.col(joins[i + 1][1]).alias(f"__link_{i + 1}")
            )
        joined = joined.join(right, F.col(f"__link_{i}") == F.col("__key"), "left")
        joined = joined.drop("__key", f"__link_{i}")
    return joined
