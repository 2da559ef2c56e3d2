"""Forecast: unit values of the planning cycles turned into totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from forecourt.fixed_values import SALES_CHANNELS
from forecourt.functions.dates import cycle_month, cycle_year
from forecourt.functions.measures import totals
from forecourt.functions.text import strip_pattern
from forecourt.operators.filters import keep_in
from forecourt.operators.lookups import recode_from
from forecourt.operators.schema import cast_all

UNIT_MEASURES = (
    "rm035", "rm036", "rm037", "rm039", "rm280", "net_revenue", "list_price_unit", "margin", "version_price",
    "options_price",
)
OTHER_AMOUNTS = ("price", "price_currency", "margin_option", "promo_cost")


def forecast(
    extract: DataFrame,
    channels: DataFrame,
    unit_measures: Sequence[str] = UNIT_MEASURES,
    other_amounts: Sequence[str] = OTHER_AMOUNTS,
) -> DataFrame:
    """Forecast lines of the two sales channels, without repetitions.

    ``channels`` maps ``forecast_name`` to ``channel``.
    """
    distinct = extract.distinct()
    numeric = cast_all(distinct, [*unit_measures, *other_amounts, "volume"], "double")
    dated = numeric.withColumns(
        {"year": cycle_year("cycle"), "date": cycle_month("cycle", "month")}
        | totals(unit_measures, "volume")
    )
    named = recode_from(dated, "client_type", channels, "forecast_name", "channel")
    tidy = named.withColumn("channel", strip_pattern("channel", r"\s"))
    return keep_in(tidy, "channel", SALES_CHANNELS).drop("channel")
