"""Prices, taxes, margins and discount flags."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.amounts import zero_to_null
from forecourt.functions.columns import ColumnLike, as_column


def net_of_tax(c: ColumnLike, rate: ColumnLike) -> Column:
    return F.try_divide(as_column(c), 1 + as_column(rate))


def tariff_with_options(tariff: ColumnLike, options: ColumnLike) -> Column:
    return as_column(tariff) + as_column(options)


def dealer_margin(discount: ColumnLike, aid: ColumnLike, bonus: ColumnLike, rate: ColumnLike) -> Column:
    """Discount before tax plus trade-in aid and conversion bonus net of tax."""
    return as_column(discount) + net_of_tax(as_column(aid) + as_column(bonus), rate)


def list_price(price: ColumnLike, margin: ColumnLike) -> Column:
    return as_column(price) * (1 + as_column(margin))


def fixed_margin_amount(price_listed: ColumnLike, margin: ColumnLike) -> Column:
    return as_column(price_listed) * as_column(margin)


def totals(measures: Iterable[str], volume: ColumnLike, suffix: str = "_total") -> dict[str, Column]:
    """Unit measures times volume, one new column each."""
    return {f"{m}{suffix}": F.col(m) * as_column(volume) for m in measures}


def advantages(
    df: DataFrame,
    discount: str = "total_discount",
    aid: str = "trade_in_aid",
    rate: str = "tax_rate",
) -> DataFrame:
    """Customer advantage after and before tax and the trade-in aid before tax."""
    aid_or_zero = F.coalesce(F.col(aid), F.lit(0))
    after = F.abs(F.coalesce(F.col(discount), F.lit(0))) + aid_or_zero
    return df.withColumns(
        {
            "advantage_after_tax": zero_to_null(after),
            "advantage_before_tax": zero_to_null(net_of_tax(after, rate)),
            "trade_in_aid_before_tax": zero_to_null(net_of_tax(aid_or_zero, rate)),
        }
    )


def discount_flags(
    df: DataFrame,
    exempt_country: str,
    country: str = "country",
    discount: str = "discount_before_tax",
    aid: str = "trade_in_aid",
    valuation: str = "trade_in_valuation",
    repurchase: str = "repurchase_before_tax",
) -> DataFrame:
    """Flags telling whether a vehicle counts for the discount reports.

    ``discount_only``: a discount and no trade-in; ``discount_with_trade_in``: all
    three amounts filled; ``usable``: either of them. The exempt country reports no
    trade-ins, so all its vehicles are usable. Unknown amounts count as not filled.
    """
    exempt = F.col(country) == exempt_country
    discounted = F.abs(F.col(discount)) > 0
    traded_in = (F.col(aid) > 0) | (F.col(valuation) > 0)
    complete = discounted & (F.col(aid) > 0) & (F.col(repurchase) > 0)
    only = F.when(exempt | traded_in, 0).when(discounted, 1).otherwise(0)
    both = F.when(exempt, 0).when(complete, 1).otherwise(0)
    return df.withColumns(
        {
            "discount_only": only,
            "discount_with_trade_in": both,
            "usable": F.when(exempt, 1).otherwise(only + both),
        }
    )
