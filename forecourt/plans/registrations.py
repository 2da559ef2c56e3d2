"""Registrations: one row per registered vehicle order, from twelve tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.functions.columns import ColumnLike, pick, sum_if
from forecourt.functions.dates import with_ymd
from forecourt.functions.text import promo_label
from forecourt.operators.aggregates import summarise
from forecourt.operators.filters import between_dates, keep_in, restrict
from forecourt.operators.joins import DimSpec, attach, attach_label
from forecourt.operators.lookups import recode

LINE_COLUMNS = (
    "vehicle", "order_date", "usage", "trim_colour", "trim_material", "engine", "sale_date", "profession",
)
ORDER_COLUMNS = tuple(f"operation_{i}" for i in range(1, 6)) + ("promo", "promo_2", "discount_percent")
VEHICLE_COLUMNS = (
    "demo", "registered_on", "available_on", "shipped_on", "arrived_on", "production_date",
)
MOVEMENT_COLUMNS = ("in_service_on", "demo_end", "registered_on")
TIMES = "__times"

# Left joins in the order they are attached: table, key of the table → key of the line, columns. Without columns
# a table only says how often a line counts. What adds most to a line comes late, since every large table costs a
# shuffle of the lines as they are by then.
OPTIONAL_TABLES: tuple[tuple[str, Mapping[str, ColumnLike], Sequence[str]], ...] = (
    ("packs", {"affiliate": "affiliate", "pack": "pack", "version": "pack_version"}, ("pack_label",)),
    ("financing", {"affiliate": "affiliate", "file_no": "file_no"}, ("reserved_on",)),
    ("movements", {"affiliate": "affiliate", "vehicle": "vehicle"}, MOVEMENT_COLUMNS),
    ("vehicles", {"affiliate": "affiliate", "vehicle": "vehicle"}, VEHICLE_COLUMNS),
    ("orders", {"affiliate": "affiliate", "order_no": "order_no"}, ORDER_COLUMNS),
    ("engines", {"affiliate": "affiliate", "engine": "engine"}, ()),
    ("usages", {"affiliate": "affiliate", "usage": "usage"}, ()),
)
ROLES = {"movements": "movement"}


def satellite(
    frame: DataFrame, name: str, on: Mapping[str, ColumnLike], columns: Sequence[str], role: str | None = None
) -> DimSpec:
    """A table beside the lines, as far as it is attached: its different rows, and how often each occurs.

    A line counts as often as it meets a row, so the number of equal rows weights the sum instead of the join.
    Tables about vehicles may have very many different rows for one.
    """
    times = f"{name}{TIMES}"
    rows = frame.groupBy(*dict.fromkeys((*on, *columns))).agg(F.count("*").alias(times))
    return DimSpec(rows, on, "left", [*columns, times], role, many="vehicle" in on, different=True)


def registrations(
    tables: Mapping[str, DataFrame],
    window: tuple[date, date],
    country: str | None = None,
    brand: str | None = None,
    country_names: Mapping[str, str] = fixed.FRENCH_COUNTRIES,
    countries: Iterable[str] = fixed.REGISTRATION_COUNTRIES,
    brands: Iterable[str] = fixed.BRANDS,
    family_affiliates: Iterable[str] = fixed.FAMILY_AFFILIATES,
    own_registration: Iterable[int] = fixed.OWN_REGISTRATION_AFFILIATES,
) -> DataFrame:
    """Registrations sold within the window.

    Countries are recoded to their English names before anything is filtered or
    joined by them. A line counts once per combination of all its attributes, with
    its emissions summed over all rows it meets in the tables beside it.
    """
    labels = recode(tables["countries"].withColumn("country", F.col("country_label")), "country", country_names)
    families = keep_in(keep_in(tables["families"], "affiliate", family_affiliates), "brand", brands)
    lines = between_dates(tables["lines"], "sale_date", *window)
    base = attach(
        lines,
        [
            DimSpec(restrict(keep_in(labels, "country", countries), country), ["affiliate"], columns=["country"]),
            DimSpec(tables["affiliates"].select("affiliate"), ["affiliate"]),
            DimSpec(
                restrict(families, brand=brand),
                {"vehicle_type": "vehicle_type", "family": F.substring("version_code", 1, 4)},
                columns=["family", "family_label", "brand"],
            ),
        ],
    )
    # Blank ids stand for no vehicle: as NULL they match nothing, and don't meet in one task.
    known = {"vehicle": F.when(F.trim("vehicle") != "", F.col("vehicle"))}
    optional = [
        satellite(tables[t], t, {**on, **known} if "vehicle" in on else on, columns, ROLES.get(t))
        for t, on, columns in OPTIONAL_TABLES
    ]
    wide = attach(base, optional)
    times = [F.coalesce(c, F.lit(1)) for c in wide.columns if c.endswith(TIMES)]
    wide = attach_label(wide, tables["professions"], "profession", "code", "label", "profession_label")
    wide = wide.withColumn(
        "registered_on",
        pick(
            F.col("affiliate").try_cast("int").isin([int(a) for a in own_registration]),
            "movement_registered_on",
            "registered_on",
        ),
    ).withColumnsRenamed({"movement_in_service_on": "in_service_on", "movement_demo_end": "demo_end"})
    keys = [
        *LINE_COLUMNS, "vehicle_type", "family", "family_label", "brand", "country", *ORDER_COLUMNS,
        *VEHICLE_COLUMNS, "in_service_on", "demo_end", "pack_label", "reserved_on", "profession_label",
    ]
    counted = summarise(wide, keys, {"co2": sum_if(F.col("vehicle").isNotNull(), reduce(Column.__mul__, times, F.col("co2")))})
    coded = recode(with_ymd(counted, "sale_date"), "vehicle_type", fixed.VEHICLE_TYPES)
    return coded.withColumns(
        {f"{op}_label": promo_label(op) for op in ORDER_COLUMNS[:5]}
        | {c: F.nullif(F.col(c), F.lit("0")) for c in ("discount_percent", "promo")}
    )
