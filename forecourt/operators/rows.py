"""Rows that come from configuration or from gaps in a reference."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def literal_rows(
    countries: DataFrame, brands: Sequence[str], rows: Sequence[Mapping[str, str]], country: str = "country"
) -> DataFrame:
    """The given rows once per country and brand.

    Countries come as a frame, brands and rows are short configured lists, so the
    combinations are unfolded row by row without a join.
    """
    templates = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in row.items())) for row in rows))
    names = F.array(*(F.lit(b) for b in brands))
    pairs = countries.select(country).distinct().select(country, F.explode(names).alias("brand"))
    return pairs.select(F.inline(templates), country, "brand")


def _known_and_new(ref: DataFrame, ops: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per key: the different other values of the reference, ``known``, and of the operations, ``new``.

    Both come in one tagged union, reduced to distinct rows before; a group holds the different rows of one
    operation, not its bookings.
    """
    others = [c for c in ops.columns if c not in on]
    tagged = [df.distinct().withColumn("__known", F.lit(known)) for df, known in ((ref, True), (ops, False))]
    both = tagged[0].unionByName(tagged[1], allowMissingColumns=True)
    values = F.struct(*others)
    return both.groupBy(*on).agg(
        F.collect_set(F.when(F.col("__known"), values)).alias("known"),
        F.collect_set(F.when(~F.col("__known"), values)).alias("new"),
    )


def _unmatched(on: Sequence[str]) -> Column:
    """Keys that the reference doesn't know; a missing key matches nothing."""
    return reduce(Column.__or__, (F.col(k).isNull() for k in on), F.size("known") == 0)


def complete(ref: DataFrame, ops: DataFrame, on: Sequence[str]) -> DataFrame:
    """Different rows of a reference, and those of operations with keys that it doesn't know.

    Both have the same columns. Known and new rows meet in one aggregate, without a join.
    """
    rows = F.when(_unmatched(on), F.concat("known", "new")).otherwise(F.col("known"))
    return _known_and_new(ref, ops.select(*ref.columns), on).select(*on, F.inline(rows)).select(*ref.columns).distinct()


def flag_missing(
    ops: DataFrame, ref: DataFrame, on: Sequence[str], flag: Mapping[str, Column]
) -> DataFrame:
    """Operations the reference does not know, with the flag columns added.

    Operations are reduced to distinct rows before the comparison.
    """
    plain = ops.withColumn("__here", F.lit(True))  # so that there is a value even where all columns are keys
    found = _known_and_new(ref.select(*on).withColumn("__here", F.lit(True)), plain, on).filter(_unmatched(on))
    return found.select(*on, F.inline("new")).select(*ops.columns).withColumns(dict(flag)).distinct()
