"""One row per key, chosen the same way on every run.

The choice is an aggregate over whole rows, not a window: every task reduces its
own rows to one per key before the shuffle, so a key with very many rows never
meets in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ranked(columns: Sequence[str], order: Sequence[str], tiebreak: Sequence[str], nulls_last: bool) -> Column:
    """Row as a struct that compares by order, tie-break and then its other columns."""
    missing = [F.col(c).isNull().alias(f"__missing_{c}") for c in order] if nulls_last else []
    ranks = [part for pair in zip(missing, order, strict=True) for part in pair] if missing else list(order)
    others = [c for c in (*tiebreak, *columns) if c not in order]
    return F.struct(*ranks, *dict.fromkeys(others))


def first_row(columns: Sequence[str], order: Sequence[str] = (), tiebreak: Sequence[str] = ()) -> Column:
    """Aggregate: the row that comes first; missing order values come last."""
    return F.min(_ranked(columns, order, tiebreak, nulls_last=True))


def last_row(columns: Sequence[str], order: Sequence[str] = (), tiebreak: Sequence[str] = ()) -> Column:
    """Aggregate: the row that comes last; missing order values come first."""
    return F.max(_ranked(columns, order, tiebreak, nulls_last=False))


def _one_row(df: DataFrame, keys: Sequence[str], row: Column) -> DataFrame:
    picked = df.groupBy(*keys).agg(row.alias("picked"))
    inside = [F.col("picked")[c].alias(c) if c not in keys else F.col(c) for c in df.columns]
    return picked.select(*inside)


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Earliest row per key; ties go to the smallest tie-break, then row values."""
    rest = [c for c in df.columns if c not in keys]
    return _one_row(df, keys, first_row(rest, order, tiebreak)) if rest else df.distinct()


def keep_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Latest row per key; ties go to the largest tie-break, then row values."""
    rest = [c for c in df.columns if c not in keys]
    return _one_row(df, keys, last_row(rest, order, tiebreak))


def roll_up(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    attributes: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Sums per key next to the attributes of the earliest row, in one shuffle."""
    first = first_row(attributes, order, tiebreak).alias("first")
    rolled = df.groupBy(*keys).agg(first, *(agg.alias(name) for name, agg in measures.items()))
    return rolled.select(*keys, *(F.col("first")[c].alias(c) for c in attributes), *measures)


def with_group_count(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Attach the number of rows that share the key."""
    names = {k: f"__key_{i}" for i, k in enumerate(keys)}
    counts = df.groupBy(*(F.col(k).alias(n) for k, n in names.items())).agg(F.count("*").alias(out))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    return df.join(counts, same, "left").select(*df.columns, out)


def resolve_conflicts(
    df: DataFrame, keys: Sequence[str], value: str, blank: str = "", unknown: str = "Unknown"
) -> DataFrame:
    """One value per key.

    A blank gives way to any other entry; what then still disagrees is unknown. A
    missing value is an entry of its own. Columns other than key and value are not
    part of the result.
    """
    filled = F.when(F.col(value) != blank, F.col(value))
    rows = df.groupBy(*keys).agg(
        F.min(filled).alias("lowest"),
        F.max(filled).alias("highest"),
        F.max(F.col(value).isNull()).alias("has_missing"),
    )
    low, missing = F.col("lowest"), F.col("has_missing")
    resolved = (
        F.when(low.isNull() & missing, None)
        .when(low.isNull(), blank)
        .when(missing | (low != F.col("highest")), unknown)
        .otherwise(low)
    )
    return rows.select(*keys, resolved.alias(value))
