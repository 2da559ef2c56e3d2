"""Budget: yearly targets from one or several extracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.functions.amounts import amount
from forecourt.functions.dates import parse_date
from forecourt.operators.lookups import recode, recode_from
from forecourt.operators.schema import cast_all, union_all

BUDGET_AMOUNTS = (
    "volume", "price_unit", "margin_unit", "net_revenue_unit", "performance_unit", "client_promo_unit",
    "company_aid_unit", "dealer_bonus_unit", "buy_back_unit", "margin_rate", "price", "margin", "net_revenue",
    "rm035", "rm036", "rm037", "rm039", "rm280",
)
BUDGET_DATE_FORMATS = ("dd/MM/yy",)


def budget_lines(
    extracts: Sequence[DataFrame],
    brand_names: Mapping[str, str],
    country_names: Mapping[str, str] = fixed.CAPITAL_COUNTRIES,
) -> DataFrame:
    """Conformed extracts of one or several years under common country and brand names."""
    lines = union_all(extracts)
    return recode(recode(lines, "country", country_names), "brand", brand_names)


def budget(
    lines: DataFrame,
    families: DataFrame,
    channels: DataFrame,
    amounts: Sequence[str] = BUDGET_AMOUNTS,
) -> DataFrame:
    """Budget without adjustment lines, amounts parsed, names mapped.

    ``families`` maps ``family_to_map`` to ``family``, ``channels`` maps
    ``budget_name`` to ``channel``.
    """
    typed = cast_all(recode(lines, "vehicle_type", fixed.VEHICLE_TYPES), ["year"], "int")
    kept = typed.filter(F.col("vehicle_type") != fixed.ADJUSTMENT)
    parsed = kept.withColumns(
        {a: amount(a) for a in amounts} | {"date": parse_date("date", BUDGET_DATE_FORMATS)}
    )
    named = recode_from(recode(parsed, "energy", fixed.EMPTY_ENERGY), "family", families, "family_to_map", "family")
    return recode_from(named, "channel", channels, "budget_name", "channel").distinct()
