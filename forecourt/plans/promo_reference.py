"""Promotion reference: the category of every commercial operation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.fixed_values import FINANCING, FIXED_MARGIN, TO_BE_FLAGGED
from forecourt.functions.text import CLIENT, NETWORK, UNKNOWN, classify_heading
from forecourt.operators.joins import DimSpec, attach
from forecourt.operators.rows import complete, flag_missing, literal_rows
from forecourt.operators.schema import union_all

COLUMNS = ("operation_label", "category", "country", "brand")
KEY = ("operation_label", "country")


def literal(*pairs: tuple[str, str]) -> list[dict[str, str]]:
    return [{"operation_label": label, "category": category} for label, category in pairs]


def classify_category(promos: DataFrame, classes: DataFrame) -> DataFrame:
    """Append the class of its category to each operation.

    A category in neither class repeats the operation name; one listed in both is a
    client promotion.
    """
    known = classes.filter(F.col("class").isin(CLIENT, NETWORK))
    unique = known.groupBy("category").agg(F.min("class").alias("class"))
    classified = attach(promos, [DimSpec(unique, ["category"], "left")])
    klass = F.coalesce("class", "operation_label")
    labelled = classified.withColumn("operation_label", F.concat("operation_label", F.lit(" - "), klass))
    return labelled.select(*COLUMNS)


def booked_operations(costs: DataFrame, network_headings: Sequence[str]) -> DataFrame:
    """Operations with costs, marked for the departments to complete."""
    ops = costs.select("operation_label", "heading_label", "country", "brand").distinct()
    klass = F.concat(F.lit(f"{TO_BE_FLAGGED} - "), classify_heading("heading_label", network_headings))
    flag = F.when(F.col("heading_label").isNotNull(), klass).otherwise(TO_BE_FLAGGED)
    return ops.withColumn("category", flag).select(*COLUMNS)


def unflagged_operations(costs: DataFrame, promos: DataFrame, network_headings: Sequence[str]) -> DataFrame:
    """Operations with costs but no category."""
    return flag_missing(booked_operations(costs, network_headings), promos, KEY, {}).select(*COLUMNS)


def promo_reference(
    promos: DataFrame,
    classes: DataFrame,
    costs: DataFrame,
    countries: DataFrame,
    brands: Sequence[str],
    network_headings: Sequence[str],
) -> DataFrame:
    """Known operations, the rows the cost mart adds, unknown ones and gaps.

    The costs and the promotions are each read once.
    """
    added = literal((FINANCING, FINANCING.upper()), (FIXED_MARGIN, FIXED_MARGIN.upper()))
    unknown = [f"{UNKNOWN} - {klass}" for klass in (CLIENT, NETWORK)]
    listed = union_all([promos.select(*COLUMNS).distinct(), literal_rows(countries, brands, added)])
    reference = union_all(
        [
            classify_category(listed, classes),
            literal_rows(countries, brands, literal(*((u, u) for u in unknown))),
        ]
    )
    return complete(reference, booked_operations(costs, network_headings), KEY)
