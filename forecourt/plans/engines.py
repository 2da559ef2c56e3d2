"""Engines: one energy per engine and country."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.functions.text import UNKNOWN, strip_pattern
from forecourt.operators.duplicates import resolve_conflicts
from forecourt.operators.filters import keep_in, restrict
from forecourt.operators.joins import DimSpec, attach
from forecourt.operators.lookups import recode


def engine_lines(
    models: DataFrame,
    countries: DataFrame,
    country: str | None = None,
    country_names: Mapping[str, str] = fixed.FRENCH_COUNTRIES,
    perimeter: Iterable[str] = fixed.REGISTRATION_COUNTRIES,
) -> DataFrame:
    """Energies registered for each engine in each country, without repetitions."""
    named = recode(countries.withColumn("country", F.col("country_label")), "country", country_names)
    wanted = restrict(keep_in(named, "country", perimeter), country)
    lines = attach(models, [DimSpec(wanted, ["affiliate"], columns=["country"])])
    return lines.select("engine", "energy", "country").distinct()


def clean_energy(lines: DataFrame, energies: Mapping[str, str] = fixed.ENERGIES) -> DataFrame:
    return recode(lines, "energy", energies).withColumn("energy", strip_pattern("energy", r"\?"))


def engines(lines: DataFrame, energies: Mapping[str, str] = fixed.ENERGIES) -> DataFrame:
    """One row per engine and country; contradicting energies are unknown."""
    return resolve_conflicts(clean_energy(lines, energies), ["engine", "country"], "energy", unknown=UNKNOWN)
