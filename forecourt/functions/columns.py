"""Small shared pieces of the column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def first_of(*cols: ColumnLike) -> Column:
    """First value that is not NULL, e.g. the registration date before the sale date."""
    return F.coalesce(*map(as_column, cols))


def pick(condition: Column, a: ColumnLike, b: ColumnLike) -> Column:
    """``a`` where the condition holds, ``b`` where it fails or is unknown."""
    return F.when(condition, as_column(a)).otherwise(as_column(b))


def key_of(*cols: ColumnLike, sep: str = " ") -> Column:
    """Parts joined by ``sep``; NULL as soon as one part is NULL."""
    parts: list[Column] = []
    for c in cols:
        if parts:
            parts.append(F.lit(sep))
        parts.append(as_column(c).cast("string"))
    return F.concat(*parts)


def sum_if(condition: Column, c: ColumnLike) -> Column:
    return F.sum(F.when(condition, as_column(c)))
