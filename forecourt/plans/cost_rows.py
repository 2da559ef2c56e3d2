"""Vehicle and promotion costs: one row per vehicle and commercial operation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.fixed_values import FINANCING, FIXED_MARGIN
from forecourt.functions.measures import fixed_margin_amount
from forecourt.functions.text import classify_heading, or_unknown
from forecourt.operators.filters import nonzero
from forecourt.operators.lookups import recode
from forecourt.operators.schema import cast_all, union_all

COST_COLUMNS = (
    "vehicle", "country", "brand", "operation_label", "heading_code", "heading_label", "operation_code", "promo_cost",
)


def promotion_costs(sales: DataFrame, headings: Mapping[str, str], earliest: str | None = None) -> DataFrame:
    """Distinct promotion costs that were booked, with operations filled in.

    With ``earliest``, each has the smallest value of that column.
    """
    booked = nonzero(sales.select(*COST_COLUMNS, *([earliest] if earliest else [])), "promo_cost")
    named = recode(booked, "heading_label", headings)
    distinct = named.groupBy(*COST_COLUMNS).agg(F.min(earliest).alias(earliest)) if earliest else named.distinct()
    return distinct.withColumns({c: or_unknown(c) for c in ("operation_code", "operation_label")})


def added_costs(vehicles: DataFrame, kinds: Mapping[str, str], carry: Sequence[str] = ()) -> DataFrame:
    """Cost rows of kinds that are no operation, named the same in all four columns.

    ``kinds`` maps the name to the column of the cost. All kinds unfold from one scan.
    """
    labels = ("operation_label", "heading_code", "heading_label", "operation_code")
    rows = [
        F.struct(*(F.lit(name).alias(c) for c in labels), F.col(cost).cast("double").alias("promo_cost"))
        for name, cost in kinds.items()
    ]
    return vehicles.select("vehicle", "country", "brand", *carry, F.inline(F.array(*rows))).select(*COST_COLUMNS, *carry)


def cost_rows(
    sales: DataFrame,
    vehicle_sales: DataFrame,
    headings: Mapping[str, str],
    network_headings: Sequence[str],
    earliest: str | None = None,
) -> DataFrame:
    """Promotion costs, storage costs and fixed margins, classified.

    ``vehicle_sales`` has one row per vehicle and country, so its cost rows need no
    de-duplication. The fixed margin is an amount of money like the other costs. ``earliest`` names a column
    of both inputs that a row takes over, the smallest value where several sales give the same cost.
    """
    carry = [earliest] if earliest else []
    keys = ["vehicle", "country", "brand", *carry]
    priced = vehicle_sales.select(
        *keys, "storage_cost", fixed_margin_amount("list_price", "fixed_margin").alias("margin_amount")
    )
    parts = [
        promotion_costs(sales, headings, earliest),
        added_costs(priced, {FINANCING: "storage_cost", FIXED_MARGIN: "margin_amount"}, carry),
    ]
    rows = union_all([cast_all(part, ["promo_cost"], "double") for part in parts])
    klass = classify_heading("heading_label", network_headings)
    return rows.withColumn("operation_label", F.concat("operation_label", F.lit(" - "), klass))
