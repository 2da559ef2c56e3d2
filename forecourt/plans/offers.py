"""Offers: the latest offer of each vehicle, with taxes taken out."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions.amounts import amount
from forecourt.functions.dates import parse_date
from forecourt.functions.measures import dealer_margin, net_of_tax, tariff_with_options
from forecourt.operators.duplicates import keep_latest
from forecourt.operators.filters import drop_blank
from forecourt.operators.joins import DimSpec, attach
from forecourt.operators.lookups import unique_ref

OFFER_AMOUNTS = (
    "accessories", "accessories_before_tax", "trade_in_aid", "extra_fees", "discount_before_tax",
    "total_discount", "final_price", "tariff_before_tax", "tariff", "options", "options_before_tax",
    "conversion_bonus", "service_contract", "emission_bonus", "trade_in_valuation",
    "conversions_before_tax", "registration_levy", "repurchase_before_tax", "tax_deduction",
)


def latest_offers(extract: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest offer per vehicle; offers without vehicle or readable date come last."""
    dated = drop_blank(extract, "vehicle").withColumn("order_date", parse_date("order_date"))
    return keep_latest(dated, ["vehicle"], ["order_date"], tiebreak)


def with_net_amounts(offers: DataFrame, tax: DataFrame) -> DataFrame:
    """Derived amounts; NULL where the country has no tax rate or an amount is missing."""
    taxed = attach(offers, [DimSpec(unique_ref(tax, "country", "tax_rate"), ["country"], "left")])
    discounts = {c: F.abs(c) for c in ("total_discount", "discount_before_tax")}
    derived = {
        "tariff_and_options_before_tax": tariff_with_options("tariff_before_tax", "options_before_tax"),
        "tariff_and_options": tariff_with_options("tariff", "options"),
        "final_price_before_tax": net_of_tax("final_price", "tax_rate"),
        "conversion_bonus_before_tax": net_of_tax("conversion_bonus", "tax_rate"),
        "trade_in_aid_before_tax": net_of_tax("trade_in_aid", "tax_rate"),
        "dealer_margin": dealer_margin(
            F.abs("discount_before_tax"), "trade_in_aid", "conversion_bonus", "tax_rate"
        ),
    }
    return taxed.withColumns(discounts | derived).drop("tax_rate")


def offers(
    extract: DataFrame,
    tax: DataFrame,
    amounts: Iterable[str] = OFFER_AMOUNTS,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Latest offers with parsed and derived amounts."""
    latest = latest_offers(extract, tiebreak)
    return with_net_amounts(latest.withColumns({a: amount(a) for a in amounts}), tax)
