"""Vehicle cost mart: sales, registrations, offers and taxes in one row per vehicle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.fixed_values import EXEMPT_COUNTRY
from forecourt.functions.columns import first_of
from forecourt.functions.dates import age_bucket, delivery_days, stock_age, vehicle_age
from forecourt.functions.measures import advantages, discount_flags
from forecourt.operators.joins import DimSpec, attach
from forecourt.operators.lookups import unique_ref

KEYS = ("country", "vehicle")
# Columns both systems know; the registration wins.
SHARED = ("sale_date", "order_date", "usage")
OFFER_COLUMNS = (
    "total_discount", "trade_in_aid", "discount_before_tax", "trade_in_valuation", "repurchase_before_tax",
)


def vehicle_cost(
    vehicle_sales: DataFrame,
    registrations: DataFrame,
    offers: DataFrame,
    tax: DataFrame,
    exempt_country: str = EXEMPT_COUNTRY,
) -> DataFrame:
    """One row per sold vehicle with its registration, latest offer and derived measures.

    Countries carry the same names on all sides. Registrations may hold several
    lines per vehicle, the other sides are unique. The date of order is that of the
    registration, else of the offer; the sales system's own one stays beside it as
    ``sold_order_date``.
    """
    sold = vehicle_sales.drop("year", "month", "day")
    sold = sold.withColumnsRenamed({c: f"sold_{c}" for c in SHARED if c in sold.columns})
    lines = registrations.drop("brand", "year", "month", "day")
    lines = lines.withColumnsRenamed({c: f"registered_{c}" for c in SHARED if c in lines.columns})
    lines = lines.withColumnsRenamed(
        {c: f"registration_{c}" for c in lines.columns if c in sold.columns and c not in KEYS}
    )
    # Equal lines would only give equal rows; the fewer meet their vehicle, the better.
    lines = lines.distinct()
    bids = offers.select(*KEYS, F.col("order_date").alias("offer_order_date"), *OFFER_COLUMNS)
    wide = attach(
        sold,
        [
            DimSpec(lines, KEYS, "left", many=True, different=True),
            DimSpec(bids, KEYS, "left"),
            DimSpec(unique_ref(tax, "country", "tax_rate"), ["country"], "left"),
        ],
    )
    merged = wide.withColumns(
        {
            "sale_date": first_of("registered_sale_date", "sold_sale_date"),
            "order_date": first_of("registered_order_date", "offer_order_date"),
        }
    )
    usages = [c for c in ("registered_usage", "sold_usage") if c in wide.columns]
    if usages:
        merged = merged.withColumn("usage", first_of(*usages))
    measured = discount_flags(advantages(merged), exempt_country)
    aged = measured.withColumn("vehicle_age", vehicle_age("order_date", "production_date")).withColumns(
        {
            "stock_age": stock_age("vehicle_age"),
            "age_bucket": age_bucket("vehicle_age"),
            "delivery_days": delivery_days("order_date", "sale_date"),
        }
    )
    working = [
        "sold_sale_date", "sold_usage", *(f"registered_{c}" for c in SHARED), "offer_order_date", "tax_rate",
        *OFFER_COLUMNS,
    ]
    # Lines can still become equal where one lacks what the sale or the offer fills in.
    return aged.drop(*working).distinct()
