"""Recoding through dictionaries and reference tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions.columns import ColumnLike, as_column
from forecourt.operators.joins import DimSpec, attach


def recode(df: DataFrame, c: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace known values; unknown values and NULL stay."""
    return df.replace(dict(mapping), subset=[c])


def unique_ref(ref: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key, the largest where the reference is ambiguous."""
    filled = ref.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    return filled.groupBy(key).agg(F.max(value).alias(value))


def ambiguous_keys(ref: DataFrame, key: str, value: str) -> DataFrame:
    """Keys the reference maps to several values, with the extremes."""
    spread = ref.groupBy(key).agg(F.min(value).alias("lowest"), F.max(value).alias("highest"))
    return spread.filter(F.col("lowest") != F.col("highest"))


def lookup(df: DataFrame, keys: ColumnLike, ref: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Attach the value of a key, NULL when the reference has none."""
    pairs = unique_ref(ref, key, value).withColumnRenamed(value, out)
    return attach(df, [DimSpec(pairs, {key: keys}, "left")])


def recode_from(df: DataFrame, c: str, ref: DataFrame, key: str, value: str) -> DataFrame:
    """Replace values found in the reference; all others stay."""
    found = "__found"
    looked_up = lookup(df, c, ref, key, value, found)
    return looked_up.withColumn(c, F.coalesce(found, c)).drop(found)


def keep_mapped(
    df: DataFrame, keys: ColumnLike, ref: DataFrame, key: str, value: str, out: str, exclude: str = "Other"
) -> DataFrame:
    """Keep rows whose key is mapped, and not to the excluded value."""
    pairs = unique_ref(ref, key, value).filter(F.col(value) != exclude).withColumnRenamed(value, out)
    return attach(df, [DimSpec(pairs, {key: as_column(keys)})])
