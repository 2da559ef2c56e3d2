"""Small reference tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.amounts import rate
from forecourt.operators.joins import DimSpec, attach
from forecourt.operators.schema import TableSpec, conform


def reference_map(extract: DataFrame, spec: TableSpec) -> DataFrame:
    """A two-column mapping table: direct sales, margins, category classes."""
    return conform(extract, spec)


def tax_rates(extract: DataFrame) -> DataFrame:
    """Tax rate per country as a number."""
    return extract.withColumn("tax_rate", rate("tax_rate"))


def families(extract: DataFrame) -> DataFrame:
    """Model families per brand, without the names they are recognised by."""
    return extract.drop("family_to_map").distinct()


def channels(extract: DataFrame) -> DataFrame:
    """Channel names only."""
    return extract.select("channel")


def category_order(extract: DataFrame) -> DataFrame:
    """Position of each promotion category in the reports."""
    return extract.withColumn("position", F.col("position").try_cast("int"))


def ordered_categories(df: DataFrame, ref: DataFrame, category: str = "category") -> DataFrame:
    """Rows with the position of their category, in report order.

    Categories without a position come last. The result is a report: sort it after
    it has been aggregated.
    """
    positions = ref.groupBy(category).agg(F.min("position").alias("position"))
    placed = attach(df, [DimSpec(positions, [category], "left")])
    return placed.orderBy(*report_order(category))


def report_order(category: str = "category") -> list[Column]:
    return [F.col("position").asc_nulls_last(), F.col(category).asc()]
