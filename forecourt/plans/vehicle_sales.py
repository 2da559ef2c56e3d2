"""Vehicle sales: one row per vehicle and country."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions.amounts import rate, zero_to_null
from forecourt.functions.measures import list_price
from forecourt.functions.text import strip_pattern
from forecourt.operators.aggregates import totals
from forecourt.operators.duplicates import roll_up
from forecourt.operators.lookups import lookup, recode_from

VEHICLE_KEYS = ("vehicle", "country")
VEHICLE_MEASURES = (
    "volume", "price", "options_price", "version_price", "margin", "margin_option", "entity_margin_version",
    "net_revenue", "storage_cost",
)
# A sum of zero means that nothing was booked, but for these.
ZERO_COUNTS = ("storage_cost",)
# Attributes of single promotion rows, which have no meaning for a whole vehicle.
PROMOTION_COLUMNS = ("operation_code", "operation_label", "heading_code", "heading_label", "promo_cost")
# Measures before adjustment and parts of margins that no vehicle report shows.
UNREPORTED_MEASURES = (
    "price_raw", "margin_raw", "margin_version", "entity_margin_raw", "entity_margin", "entity_margin_option",
)


def vehicle_rollup(
    sales: DataFrame,
    measures: Sequence[str],
    attributes: Sequence[str],
    keys: Sequence[str] = VEHICLE_KEYS,
    order: Sequence[str] = ("sale_date",),
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Sums of all sales of a vehicle next to the attributes of its earliest sale.

    Totals of zero become NULL, but for those in ``ZERO_COUNTS``. Both are computed by one
    aggregation, so the fact is shuffled once and reduced before.
    """
    rolled = roll_up(sales, keys, totals(sales, measures), attributes, order, tiebreak)
    return rolled.withColumns({m: zero_to_null(m) for m in measures if m not in ZERO_COUNTS})


def price_list(vehicles: DataFrame, margins: DataFrame, key: str = "margin_key") -> DataFrame:
    """Add fixed margin and list price; both NULL where no margin is agreed.

    ``margins`` holds ``key`` and the margin as text or number.
    """
    found = lookup(vehicles, key, margins, "key", "margin", "fixed_margin")
    numeric = found.withColumn("fixed_margin", rate(F.col("fixed_margin").cast("string")))
    return numeric.withColumn("list_price", list_price("price", "fixed_margin"))


def vehicle_sales(
    sales: DataFrame,
    channels: DataFrame,
    families: DataFrame,
    margins: DataFrame,
    measures: Sequence[str] = VEHICLE_MEASURES,
    order: Sequence[str] = ("sale_date",),
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Vehicle roll-up with channel and family names, segment and list price.

    ``channels`` maps ``sales_name`` to ``channel``, ``families`` maps
    ``family_to_map`` to ``family``. Names are recoded after the roll-up, on one row
    per vehicle.
    """
    dropped = {*VEHICLE_KEYS, *measures, *PROMOTION_COLUMNS, *UNREPORTED_MEASURES}
    attributes = [c for c in sales.columns if c not in dropped]
    vehicles = vehicle_rollup(sales, measures, attributes, order=order, tiebreak=tiebreak)
    vehicles = recode_from(vehicles, "major_client_type_label", channels, "sales_name", "channel")
    vehicles = recode_from(vehicles, "family_label", families, "family_to_map", "family")
    vehicles = vehicles.withColumn("segment_label", strip_pattern("segment_label", "SEGMENT "))
    return price_list(vehicles, margins).drop("margin_key")
