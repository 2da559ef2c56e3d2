"""Calendar tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar_columns(day: str = "date") -> dict[str, Column]:
    """Report attributes of a day; month names are English."""
    d = F.col(day)
    quarter = F.concat(F.lit("Q"), F.quarter(d).cast("string"))
    return {
        "day": F.date_format(d, "dd"),
        "month": F.month(d),
        "year": F.year(d),
        "month_year_number": F.date_format(d, "M/yy"),
        "month_name_short": F.date_format(d, "MMM"),
        "month_name_long": F.date_format(d, "MMMM"),
        "month_year_short": F.date_format(d, "MMM-yyyy"),
        "month_year_long": F.date_format(d, "MMMM yyyy"),
        "quarter": quarter,
        "year_quarter": F.concat_ws(" ", F.year(d).cast("string"), quarter),
        "date_as_integer": F.date_format(d, "yyyyMMdd").cast("int"),
        "month_as_integer": F.date_format(d, "yyyyMM").cast("int"),
    }


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = spark.range((end - start).days + 1)
    dated = days.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))
    return dated.withColumns(calendar_columns())


def calendar_of(df: DataFrame, c: str) -> DataFrame:
    """One row per day between the first and the last date that occurs."""
    bounds = df.agg(F.min(c).cast("date").alias("first"), F.max(c).cast("date").alias("last"))
    days = bounds.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last")).alias("date")
    )
    return days.withColumns(calendar_columns())
