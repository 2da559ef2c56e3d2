"""Runs of the marts from zone to zone.

Zones exchange tables only: each step reads the tables it needs and writes one. A
step that fails, or a lost executor, costs the work of that step alone: the same run, started again, goes on
with the step that failed, unless what the others read or wrote has changed meanwhile.

Marts that follow the window are stored by month, in a partition column ``period`` that readers don't see.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.operators.calendar import calendar
from forecourt.operators.filters import restrict
from forecourt.operators.history import Window, last_days, month_partitions, month_windows, months_of, reduce_fact
from forecourt.operators.lookups import recode
from forecourt.operators.schema import TableSpec, conform, union_all
from forecourt.plans import layouts
from forecourt.plans.budget import budget, budget_lines
from forecourt.plans.cost_rows import cost_rows
from forecourt.plans.dealers import dealers
from forecourt.plans.engines import engine_lines, engines
from forecourt.plans.forecast import forecast
from forecourt.plans.ledger import Ledger
from forecourt.plans.offers import offers
from forecourt.plans.promo_reference import promo_reference
from forecourt.plans.publication import publish
from forecourt.plans.references import category_order, channels, families, tax_rates
from forecourt.plans.registrations import registrations
from forecourt.plans.sales import sales
from forecourt.plans.vehicle_cost import vehicle_cost
from forecourt.plans.vehicle_sales import vehicle_sales
from forecourt.sources.extracts import read_extract, read_extract_set
from forecourt.sources.files import content_of
from forecourt.sources.zones import Landed, land, read_zone, snapshot, write_zone

ZONES = ("source", "raw", "standard", "refined", "published")
SITE = ("country", "brand")
PERIOD = "period"


@dataclass(frozen=True)
class Settings:
    """Where things are and the names that differ from site to site.

    ``source`` holds the tables of both systems, ``extracts`` the delivered files,
    ``root`` the zones. ``database`` is a JDBC URL.
    """

    root: str
    source: str
    extracts: str
    database: str | None = None
    database_properties: Mapping[str, str] = field(default_factory=dict)
    issuer: str = "Group"
    brand_names: Mapping[str, str] = field(default_factory=dict)
    brands: Sequence[str] = fixed.BRANDS
    offer_countries: Sequence[str] = fixed.OFFER_COUNTRIES
    channel_headers: tuple[str, str, str] = ("forecast_lib", "sales_lib", "budget_lib")
    subfamily_header: str = "LIBELLE_SOUSFAMILLE"
    salt: str = fixed.SALT
    historical: bool = False
    profession_headers: tuple[str, str] = ("code", "label")


@dataclass(frozen=True)
class Run:
    """One execution: session, settings, window and restriction.

    ``period`` is the month, as the number yyyymm, that a back-fill is at.
    """

    spark: SparkSession
    settings: Settings
    window: tuple[date, date]
    country: str | None = None
    brand: str | None = None
    period: int | None = None

    def path(self, zone: str, table: str) -> str:
        return f"{self.settings.root}/{zone}/{table}"

    def content(self, name: str) -> str:
        """The folder that a step reads or writes, of a mart by month that month's alone."""
        zone, table = name.split(".")
        path = self.path(zone, table)
        return f"{path}/{PERIOD}={self.period}" if self.period and name in BY_MONTH else path

    def read(self, zone: str, table: str, site: bool = False, dated: bool = False) -> DataFrame:
        """A table, in a back-fill its month; ``dated`` keeps the column with the month."""
        country, brand = (self.country, self.brand) if site else (None, None)
        df = read_zone(self.spark, self.path(zone, table), country, brand)
        if f"{zone}.{table}" not in BY_MONTH:
            return df
        if self.period:
            df = df.filter(F.col(PERIOD) == self.period)
        return df if dated else df.drop(PERIOD)

    def system(self, name: str, columns: Mapping[str, Mapping[str, str]]) -> dict[str, DataFrame]:
        """Landed tables of a source system under our column names, facts of the months in question."""
        tables = {}
        for table, headers in columns.items():
            landed = self.read("raw", f"{name}/{table}")
            if table in FACTS:
                landed = landed.filter(in_months(self.window))
            types = layouts.SALES_TYPES if (name, table) == ("sales", "facts") else {}
            tables[table] = conform(landed, TableSpec(headers, types=types))
        return tables

    def registration_layout(self) -> dict[str, Mapping[str, str]]:
        code, label = self.settings.profession_headers
        return layouts.REGISTRATION_TABLES | {"professions": {code: "code", label: "label"}}

    def file(self, name: str, spec: TableSpec) -> DataFrame:
        return read_extract(self.spark, f"{self.settings.extracts}/{name}.csv", spec)

    def files(self, prefix: str, specs: Mapping[str, TableSpec]) -> DataFrame:
        """Files of several countries, each in the layout of its country."""
        wanted = [c for c in specs if self.country in (None, fixed.COUNTRY_CODES[c])]
        frames = [
            read_extract_set(self.spark, self.settings.extracts, f"{prefix}_{c}", c, specs[c]) for c in wanted
        ]
        return self.named(union_all(frames), fixed.COUNTRY_CODES)

    def named(self, df: DataFrame, countries: Mapping[str, str]) -> DataFrame:
        """Common country names, then the restriction."""
        brand = self.brand if "brand" in df.columns else None
        return restrict(recode(df, "country", countries), self.country, brand)


@dataclass(frozen=True)
class Step:
    """Builds one table of one zone from the tables that ``reads`` names as zone and table.

    ``request`` is the name a run asks for, where that isn't the table's own. ``by_month`` is the date that puts
    a row in its month, for marts that follow the window; one that already has the month as ``period`` keeps it.
    """

    zone: str
    table: str
    build: Callable[[Run], DataFrame]
    partition_by: Sequence[str] = ()
    reads: Sequence[str] = ()
    request: str | None = None
    by_month: str | None = None

    @property
    def name(self) -> str:
        return f"{self.zone}.{self.table}"

    def write(self, run: Run, only: Mapping[str, object]) -> None:
        """Build the table and replace it, or its partitions ``only``, in a back-fill those of the month."""
        df, partition_by = self.build(run), tuple(self.partition_by)
        if self.by_month:
            if PERIOD not in df.columns:
                df = df.withColumn(PERIOD, F.year(self.by_month) * 100 + F.month(self.by_month))
            partition_by = (PERIOD, *partition_by)
            only = only | ({PERIOD: run.period} if run.period else {})
        write_zone(df, run.path(self.zone, self.table), partition_by, only=[only] if only else ())


# --- standard zone ------------------------------------------------------------------


def standard_registrations(run: Run) -> DataFrame:
    tables = run.system("registration", run.registration_layout())
    return registrations(tables, run.window, run.country, run.brand, brands=run.settings.brands)


def standard_sales(run: Run) -> DataFrame:
    tables = run.system("sales", layouts.SALES_TABLES)
    tables["channel_types"] = run.read("standard", "channel_types")
    return sales(tables, run.window, run.country, run.brand)


def standard_engines(run: Run) -> DataFrame:
    names = ("engines", "countries")
    tables = run.system("registration", {t: layouts.REGISTRATION_TABLES[t] for t in names})
    return engine_lines(tables["engines"], tables["countries"], run.country)


def standard_forecast(run: Run) -> DataFrame:
    spec = layouts.forecast(run.settings.subfamily_header)
    lines = read_extract_set(run.spark, run.settings.extracts, "forecast_", spec=spec, multiline=True)
    return run.named(lines, fixed.CAPITAL_COUNTRIES)


def standard_budget(run: Run) -> DataFrame:
    lines = read_extract_set(run.spark, run.settings.extracts, "budget_", spec=layouts.BUDGET)
    return restrict(budget_lines([lines], run.settings.brand_names), run.country, run.brand)


def extract_step(table: str, spec: TableSpec, partition_by: Sequence[str] = ()) -> Step:
    """A file taken over as it is."""
    return Step("standard", table, lambda run: run.file(table, spec), partition_by)


# --- refined zone -------------------------------------------------------------------


def refined_offers(run: Run) -> DataFrame:
    return offers(run.read("standard", "offers", site=True), tax_rates(run.read("standard", "tax_rates")))


def refined_vehicle_sales(run: Run) -> DataFrame:
    return vehicle_sales(
        run.read("standard", "sales", site=True),
        run.read("standard", "channels"),
        run.read("standard", "families"),
        run.read("standard", "margins"),
    )


def refined_vehicle_cost(run: Run) -> DataFrame:
    return vehicle_cost(
        run.read("refined", "vehicle_sales", site=True),
        run.read("standard", "registrations", site=True),
        run.read("refined", "offers", site=True),
        tax_rates(run.read("standard", "tax_rates")),
    )


def refined_cost_rows(run: Run) -> DataFrame:
    headings, network = fixed.issued(run.settings.issuer)
    booked, vehicles = (run.read(z, t, site=True, dated=True) for z, t in (("standard", "sales"), ("refined", "vehicle_sales")))
    return cost_rows(booked, vehicles, headings, network, earliest=PERIOD)


def refined_promo_reference(run: Run) -> DataFrame:
    """Reference of the restricted countries and brands, or of all of them."""
    brands = [run.brand] if run.brand else list(run.settings.brands)
    names = {fixed.COUNTRY_CODES[c] for c in run.settings.offer_countries}
    countries = [[run.country]] if run.country else [[n] for n in sorted(names)]
    return promo_reference(
        run.read("standard", "promotions", site=True),
        run.read("standard", "classes"),
        run.read("refined", "cost_rows", site=True),
        run.spark.createDataFrame(countries, "country string"),
        brands,
        fixed.issued(run.settings.issuer)[1],
    )


def refined_forecast(run: Run) -> DataFrame:
    return forecast(run.read("standard", "forecast", site=True), run.read("standard", "channels"))


def refined_budget(run: Run) -> DataFrame:
    lines = run.read("standard", "budget", site=True)
    return budget(lines, run.read("standard", "families"), run.read("standard", "channels"))


STEPS: tuple[Step, ...] = (
    extract_step("classes", layouts.CLASSES),
    extract_step("channel_types", layouts.CHANNEL_TYPES),
    extract_step("margins", layouts.MARGINS),
    Step("standard", "channels", lambda run: run.file("channels", layouts.channels(*run.settings.channel_headers))),
    extract_step("families", layouts.FAMILIES, ("brand",)),
    extract_step("tax_rates", layouts.TAX_RATES),
    extract_step("category_order", layouts.CATEGORY_ORDER),
    Step("standard", "engines", standard_engines, ("country",), ("raw.registration",)),
    Step("standard", "registrations", standard_registrations, SITE, ("raw.registration",), by_month="sale_date"),
    Step("standard", "sales", standard_sales, SITE, ("raw.sales", "standard.channel_types"), by_month="sale_date"),
    Step("standard", "offers", lambda run: run.files("offers", layouts.OFFERS), SITE),
    Step("standard", "forecast", standard_forecast, SITE),
    Step(
        "standard",
        "promotions",
        lambda run: run.files("promotions", dict.fromkeys(run.settings.offer_countries, layouts.PROMOTIONS)),
        SITE,
    ),
    Step(
        "standard",
        "dealers",
        lambda run: run.named(run.file("dealers", layouts.DEALERS), fixed.CAPITAL_COUNTRIES),
        SITE,
    ),
    Step("standard", "budget", standard_budget, SITE),
    Step("refined", "sale_calendar", lambda run: calendar(run.spark, *run.window), by_month="date"),
    Step("refined", "order_calendar", lambda run: calendar(run.spark, *run.window), by_month="date"),
    Step(
        "refined",
        "category_order",
        lambda run: category_order(run.read("standard", "category_order")),
        reads=("standard.category_order",),
    ),
    Step(
        "refined",
        "engines",
        lambda run: engines(run.read("standard", "engines", site=False)),
        ("country",),
        ("standard.engines",),
    ),
    Step(
        "refined",
        "tax_rates",
        lambda run: tax_rates(run.read("standard", "tax_rates")),
        ("country",),
        ("standard.tax_rates",),
    ),
    Step(
        "refined",
        "dealers",
        lambda run: dealers(run.read("standard", "dealers", site=True)),
        SITE,
        ("standard.dealers",),
    ),
    Step(
        "refined",
        "families",
        lambda run: families(run.read("standard", "families")),
        ("brand",),
        ("standard.families",),
    ),
    Step("refined", "channels", lambda run: channels(run.read("standard", "channels")), reads=("standard.channels",)),
    Step("refined", "budget", refined_budget, SITE, ("standard.budget", "standard.families", "standard.channels")),
    Step("refined", "forecast", refined_forecast, SITE, ("standard.forecast", "standard.channels")),
    Step(
        "refined",
        "vehicle_sales",
        refined_vehicle_sales,
        SITE,
        ("standard.sales", "standard.channels", "standard.families", "standard.margins"),
        "sales",
        "sale_date",
    ),
    Step("refined", "cost_rows", refined_cost_rows, SITE, ("standard.sales", "refined.vehicle_sales"), by_month="sale_date"),
    Step(
        "refined",
        "promo_reference",
        refined_promo_reference,
        SITE,
        ("standard.promotions", "standard.classes", "refined.cost_rows"),
    ),
    Step("refined", "offers", refined_offers, SITE, ("standard.offers", "standard.tax_rates")),
    Step(
        "refined",
        "vehicle_cost",
        refined_vehicle_cost,
        SITE,
        ("refined.vehicle_sales", "standard.registrations", "refined.offers", "standard.tax_rates"),
        by_month="sale_date",
    ),
)
BY_MONTH = frozenset(step.name for step in STEPS if step.by_month)
# The vehicle sales only feed other marts.
UNPUBLISHED = ("vehicle_sales",)
SYSTEMS = {"registration": layouts.REGISTRATION_TABLES, "sales": layouts.SALES_TABLES}
# Tables that grow with time, in either system.
FACTS = ("lines", "facts")


def in_months(window: Window) -> Column:
    """Filter on the month folders that a window touches."""
    start, end = window
    month = F.col("year") * 12 + F.col("month")
    return month.between(start.year * 12 + start.month, end.year * 12 + end.month)


def requests() -> list[str]:
    """Everything a run can be asked for."""
    return ["all", *dict.fromkeys(step.table for step in STEPS)]


def needed(request: str) -> set[str]:
    """Names of the steps and source systems that a request rests on."""
    steps = {step.name: step for step in STEPS}
    todo = [s.name for s in STEPS if request in ("all", s.table, s.request)]
    found: set[str] = set()
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo.extend(steps[name].reads if name in steps else ())
    return found


def land_months(run: Run, source: str, folder: str, fact: str, date_column: str, months: Sequence[Window]) -> None:
    """Copy months of a fact, but for those that were copied from the same files before."""
    landed, content, path = Landed(run.spark, folder), content_of(run.spark, source), f"{folder}/{fact}"
    copies = {m: f"{path}/year={m[0].year}/month={m[0].month}" for m in months}
    names = {m: f"{fact}/{m[0]:%Y-%m}" for m in months}
    wanted = [m for m in months if not landed.current(names[m], content, copies[m])]
    if wanted:
        rows = reduce_fact(run.spark.read.parquet(source), date_column, wanted[0][0], wanted[-1][1])
        write_zone(rows.drop("day"), path, ("year", "month"), only=month_partitions(wanted))
    for m in wanted:
        landed.record(names[m], content, copies[m])


def land_systems(run: Run, systems: Iterable[str], as_of: datetime, ledger: Ledger) -> list[str]:
    """Copy the source tables, and keep a dated image of the copy if wanted. Returns the systems copied.

    Facts are landed by month, and only the months that the window touches; the others stay. Tables and months that
    haven't changed since they were copied aren't copied again.
    """
    months = months_of(run.window)
    copied = []
    for system in systems:
        source = f"{run.settings.source}/{system}"
        if ledger.done(f"raw.{system}", [source], [run.path("raw", system)]):
            continue
        copies = run.path("raw", system)
        land(run.spark, {t: () for t in SYSTEMS[system] if t not in FACTS}, source, copies)
        for fact in (t for t in SYSTEMS[system] if t in FACTS):
            date_column = {ours: theirs for theirs, ours in SYSTEMS[system][fact].items()}["sale_date"]
            land_months(run, f"{source}/{fact}", copies, fact, date_column, months)
        if run.settings.historical:
            images = f"{run.settings.root}/historical/{system}"
            kept: dict[str, Iterable[str]] = {t: ("year", "month") if t in FACTS else () for t in SYSTEMS[system]}
            snapshot(run.spark, kept, run.path("raw", system), images, as_of)
        ledger.record(f"raw.{system}", [source], [run.path("raw", system)])
        copied.append(system)
    return copied


def following(names: Iterable[str]) -> set[str]:
    """Steps that rest on any of the given ones."""
    found = set(names)
    for step in STEPS:  # in order of what they read
        if found & set(step.reads):
            found.add(step.name)
    return found


def run(
    spark: SparkSession,
    settings: Settings,
    table: str = "all",
    from_zone: str = "source",
    to_zone: str = "published",
    window: tuple[date, date] | None = None,
    country: str | None = None,
    brand: str | None = None,
    now: datetime | None = None,
    months: int | None = None,
) -> list[tuple[str, str]]:
    """Bring one table, or all, from one zone to another, with all that it rests on.

    The window defaults to the last thirty days. A country is given by code or name.
    A table is replaced as a whole, by a restricted run in the partitions of its country and
    brand. With ``months`` the run is a back-fill of that many whole months from the month of the window's first day on:
    marts that follow the window are built month by month, as if each were the window, and the partitions
    of these months replaced, no others. Tables that don't follow the window are built once, before the months
    or, where they rest on monthly marts, after them.

    A run that failed and is started again with the same arguments leaves out the steps, and months, whose
    inputs and results are unchanged. Returns the zone and table of every step done, in order.
    """
    if table not in requests():
        raise ValueError(f"unknown table {table}; one of {', '.join(requests())}")
    for zone in (from_zone, to_zone):
        if zone not in ZONES:
            raise ValueError(f"unknown zone {zone}; one of {', '.join(ZONES)}")
    now = now or datetime.now()
    country = fixed.COUNTRY_CODES.get(country, country) if country else None
    window = window or last_days(now.date())
    filled = list(month_windows(window[0], months)) if months else []
    if filled:
        window = (filled[0][0], filled[-1][1])
    this = Run(spark, settings, window, country, brand)
    asked = {"table": table, "zones": [from_zone, to_zone], "window": window, "months": months, "country": country, "brand": brand}
    ledger = Ledger(spark, settings.root, asked | {"settings": repr(settings)})
    rests_on = needed(table)
    wanted = ZONES[ZONES.index(from_zone) + 1 : ZONES.index(to_zone) + 1]
    steps = [step for step in STEPS if step.zone in wanted and step.name in rests_on]
    done: list[tuple[str, str]] = []
    if "raw" in wanted and land_systems(this, [s for s in SYSTEMS if f"raw.{s}" in rests_on], now, ledger):
        done.append(("raw", table))
    if filled:
        late = following(BY_MONTH) - BY_MONTH
        done += take(this, [s for s in steps if s.name not in BY_MONTH and s.name not in late], ledger)
        for month in filled:
            one = replace(this, window=month, period=month[0].year * 100 + month[0].month)
            done += take(one, [s for s in steps if s.by_month], ledger)
        done += take(this, [s for s in steps if s.name in late], ledger)
    else:
        done += take(this, steps, ledger)
    if "published" in wanted:
        done += publish_marts(this, table, ledger)
    ledger.close()
    return done


def take(run: Run, steps: Iterable[Step], ledger: Ledger) -> list[tuple[str, str]]:
    """Do the steps that aren't done yet."""
    site = {c: v for c, v in zip(SITE, (run.country, run.brand), strict=True) if v is not None}
    done = []
    for step in steps:
        key = f"{run.period}/{step.name}" if run.period else step.name
        reads = [run.content(name) for name in step.reads] or [run.settings.extracts]
        writes = [run.content(step.name)]
        if not ledger.done(key, reads, writes):
            step.write(run, site)
            ledger.record(key, reads, writes)
            done.append((step.zone, step.table))
    return done


def publish_marts(run: Run, request: str, ledger: Ledger) -> list[tuple[str, str]]:
    """Publish the refined tables that were asked for, identifiers hidden in all of them."""
    if run.settings.database is None:
        raise ValueError("publishing needs a database")
    names = [s.table for s in STEPS if s.zone == "refined" and request in ("all", s.table) and s.table not in UNPUBLISHED]
    done = []
    for name in names:
        reads = [run.content(f"refined.{name}")]
        if not ledger.done(f"published.{name}", reads, ()):
            publish(
                run.read("refined", name),
                run.settings.database,
                name,
                salt=run.settings.salt,
                properties=run.settings.database_properties,
            )
            ledger.record(f"published.{name}", reads, ())
            done.append(("published", name))
    return done
