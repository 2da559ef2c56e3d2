"""Group-by totals and control counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def summarise(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Named aggregates per combination of keys."""
    return df.groupBy(*keys).agg(*(agg.alias(name) for name, agg in measures.items()))


def totals(df: DataFrame, measures: Sequence[str]) -> dict[str, Column]:
    """Sum of each measure.

    Decimals are summed exactly and become a double after the sum; integers and doubles are
    summed as they are. Layouts declare amounts of money as decimals, so that their sums
    don't depend on the order of the rows.
    """
    decimals = {c for c, t in df.dtypes if t.startswith("decimal")}
    return {m: F.sum(m).cast("double") if m in decimals else F.sum(m) for m in measures}


def sum_by(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum of each measure per key, under the name of the measure."""
    return summarise(df, keys, totals(df, measures))


def count_by(df: DataFrame, c: str, out: str = "n") -> DataFrame:
    return summarise(df, [c], {out: F.count("*")})


def reconcile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows next to the number of different keys."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys")
    )


def varchar_widths(df: DataFrame) -> DataFrame:
    """Longest text of every string column, at least 1, in one pass."""
    names = [c for c, t in df.dtypes if t == "string"]
    widths = df.agg(
        *(F.greatest(F.coalesce(F.max(F.length(c)), F.lit(0)), F.lit(1)).alias(c) for c in names)
    )
    entries = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("width")) for c in names))
    return widths.select(F.inline(entries))
