"""Sales: a fact with sixteen dimension joins, summed to the grain of the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.functions.columns import key_of
from forecourt.functions.dates import with_ymd
from forecourt.functions.text import label, zone_country
from forecourt.operators.aggregates import summarise, totals
from forecourt.operators.filters import between_dates, keep_in, restrict
from forecourt.operators.joins import DimSpec, attach
from forecourt.operators.lookups import keep_mapped, recode


@dataclass(frozen=True)
class Dimension:
    """A dimension table of the sales system.

    It holds ``code`` and, if ``labelled``, ``label_fr``, ``label_en``, ``label_es``;
    both are attached under the name of the dimension. ``carry`` lists further
    columns later joins need. ``only`` keeps the given codes.
    """

    name: str
    on: Mapping[str, str]
    how: str = "inner"
    table: str | None = None
    labelled: bool = True
    fallback: bool = True
    carry: Sequence[str] = ()
    only: Sequence[str] | None = None
    reported: bool = True

    def columns(self) -> list[str]:
        return [f"{self.name}_code"] + ([f"{self.name}_label"] if self.labelled else [])

    def spec(self, tables: Mapping[str, DataFrame], locale: str) -> DimSpec:
        frame = tables[self.table or self.name]
        if self.only is not None:
            frame = keep_in(frame, "code", self.only)
        code = F.col("code").alias(f"{self.name}_code")
        shown = [label("label", locale, self.fallback).alias(f"{self.name}_label")] if self.labelled else []
        keys = [F.col(k) for k in self.on]
        return DimSpec(frame.select(*keys, code, *shown, *self.carry), dict(self.on), self.how)


def in_zone(name: str, *, how: str = "inner", fact_key: str | None = None, **options: object) -> Dimension:
    """Dimension whose ids are unique within a sales zone only."""
    return Dimension(name, {"zone_id": "zone_id", "id": fact_key or f"{name}_id"}, how, **options)


# Dimensions that filter come first, so that the later joins see fewer rows.
SALES_DIMENSIONS: tuple[Dimension, ...] = (
    Dimension("base", {"id": "base_id"}, labelled=False, only=(fixed.SALES_BASE,), reported=False),
    Dimension("zone", {"id": "zone_id"}, only=fixed.SALES_ZONES),
    in_zone("company"),
    in_zone("minor_client_type"),
    in_zone("family", carry=("brand_id",)),
    Dimension("brand", {"id": "brand_id"}, labelled=False),
    in_zone("subfamily"),
    in_zone("version"),
    in_zone("segment", how="left"),
    Dimension("heading", {"id": "heading_id"}, "left", fallback=False),
    in_zone("operation", how="left", fallback=False),
    Dimension("channel", {"id": "channel_id"}),
    Dimension("major_client_type", {"id": "major_client_type_id"}),
    Dimension("client", {"zone_id": "zone_id", "group_id": "group_id", "id": "client_id"}),
    Dimension(
        "delivered",
        {"zone_id": "zone_id", "group_id": "group_id", "id": "delivered_id"},
        table="client",
        labelled=False,
    ),
    in_zone("vehicle", labelled=False),
)

SALES_ATTRIBUTES = (
    "invoice_date", "sale_date", "order_date", "registered_on", "fleet_type", "fleet_operation", "usage",
    "profession", "promo", "promo_2",
)
SALES_MEASURES = (
    "volume", "price_raw", "price", "options_price", "version_price", "margin_raw", "margin", "margin_version",
    "margin_option", "entity_margin_raw", "entity_margin", "entity_margin_version", "entity_margin_option",
    "net_revenue", "promo_cost", "storage_cost",
)


@dataclass(frozen=True)
class SalesModel:
    """What the sales mart joins, groups by and sums.

    ``first`` names the dimensions with very many rows in the order they are joined, best one that has the keys by which the
    fact is dealt already, then those with few columns; the others are lists of codes.
    """

    dimensions: Sequence[Dimension] = SALES_DIMENSIONS
    first: Sequence[str] = ("vehicle", "delivered", "client", "version")
    attributes: Sequence[str] = SALES_ATTRIBUTES
    measures: Sequence[str] = SALES_MEASURES
    channel_key: Sequence[str] = (
        "country", "brand", "channel_code", "major_client_type_code", "minor_client_type_code",
    )
    margin_key: Sequence[str] = ("year", "country", "version_code")
    country_names: Mapping[str, str] = field(default_factory=lambda: fixed.COUNTRY_CODES)


def summed_by_id(tables: Mapping[str, DataFrame], window: tuple[date, date], model: SalesModel) -> DataFrame:
    """The fact of the window summed over its own attributes and the ids of its dimensions.

    Sums are taken before anything is looked up, so the fact is shuffled with ids instead of labels, and only once.
    Dimensions that keep some codes drop the other sales before that, without being attached.
    Amounts stay decimals, since they are summed again.
    """
    facts = between_dates(tables["facts"], "sale_date", *window)
    for d in model.dimensions:
        if d.only is not None and d.how == "inner" and set(d.on.values()) <= set(facts.columns):
            kept = d.spec(tables, "fr").frame.select(*(F.col(k).alias(f"__{k}") for k in d.on))
            same = reduce(Column.__and__, (F.col(c) == F.col(f"__{k}") for k, c in d.on.items()))
            facts = facts.join(kept, same, "left_semi")
    ids = dict.fromkeys(c for d in model.dimensions for c in d.on.values() if c in facts.columns)
    return summarise(facts, [*model.attributes, *(c for c in ids if c not in model.attributes)], {m: F.sum(m) for m in model.measures})


def sales_wide(
    tables: Mapping[str, DataFrame],
    window: tuple[date, date],
    model: SalesModel = SalesModel(),
    locale: str = "fr",
) -> DataFrame:
    """The fact joined with its dimensions and summed over everything it reports.

    Labels are joined to the sums by id, and sums are added up where different ids have the same labels. A
    dimension with several rows for an id counts a sale as often, as it would before the sum. Sums are dealt by the
    columns of the large dimensions, all of which the report has, before the lists of codes are attached, so the last sum
    needs no shuffle with all labels where the lists are broadcast.
    """
    named = {d.name: d for d in model.dimensions}
    large = [named[n] for n in model.first if n in named]
    lists = [d for d in model.dimensions if d not in large]
    wide = attach(summed_by_id(tables, window, model), [d.spec(tables, locale) for d in large])
    shown = [c for d in large if d.reported for c in d.columns()]
    if shown:
        wide = wide.repartition(*model.attributes, *shown)
    wide = attach(wide, [d.spec(tables, locale) for d in lists])
    keys = [*model.attributes, *(c for d in model.dimensions if d.reported for c in d.columns())]
    return summarise(wide, keys, totals(wide, model.measures))


def sales(
    tables: Mapping[str, DataFrame],
    window: tuple[date, date],
    country: str | None = None,
    brand: str | None = None,
    model: SalesModel = SalesModel(),
    locale: str = "fr",
) -> DataFrame:
    """Direct sales by vehicle and promotion, with the keys of channel type and margin.

    ``tables`` holds the fact, its dimensions and ``channel_types``. Sales whose
    channel type is unknown or ``Other`` are not direct and left out.
    """
    wide = with_ymd(sales_wide(tables, window, model, locale), "sale_date")
    wide = wide.withColumnsRenamed({"vehicle_code": "vehicle", "brand_code": "brand"})
    wide = wide.withColumn("country", zone_country("zone_code"))
    keyed = wide.withColumns(
        {"channel_key": key_of(*model.channel_key), "margin_key": key_of(*model.margin_key)}
    )
    named = restrict(recode(keyed, "country", model.country_names), country, brand)
    direct = keep_mapped(named, "channel_key", tables["channel_types"], "key", "channel_type", "channel_type")
    return direct.drop("channel_key")
