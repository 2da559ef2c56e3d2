"""Command line: ``python -m forecourt``, or with spark-submit on this file.

Settings come from a JSON file with the fields of ``forecourt.plans.run.Settings``.
"""

from __future__ import annotations

import json
from argparse import ArgumentParser
from collections.abc import Sequence
from datetime import date, datetime
from pathlib import Path

from pyspark.sql import SparkSession

from forecourt.plans.run import ZONES, Settings, requests, run
from forecourt.session import tune


def day(text: str) -> date:
    return datetime.strptime(text, "%d/%m/%Y").date()


def arguments(argv: Sequence[str] | None = None) -> dict[str, object]:
    """Arguments of ``run`` from the command line."""
    parser = ArgumentParser(prog="forecourt", description="Bring marts from zone to zone.")
    parser.add_argument("--settings", required=True, help="JSON file")
    parser.add_argument("--table", default="all", choices=requests())
    parser.add_argument("--from-zone", default="source", choices=ZONES[:-1])
    parser.add_argument("--to-zone", required=True, choices=ZONES[1:])
    parser.add_argument("--from-date", type=day, help="first sale date, dd/mm/yyyy")
    parser.add_argument("--to-date", type=day, help="last sale date, dd/mm/yyyy")
    parser.add_argument("--country", help="code or name")
    parser.add_argument("--brand")
    parser.add_argument("--months", type=int, help="back-fill so many months from the month of --from-date on")
    parser.add_argument("--image", action="store_true", help="keep a dated copy of the landed tables")
    given = parser.parse_args(argv)
    if given.months and given.from_date and given.to_date is None:
        given.to_date = given.from_date
    if (given.from_date is None) != (given.to_date is None):
        parser.error("--from-date and --to-date go together")
    settings = json.loads(Path(given.settings).read_text(encoding="utf-8"))
    return {
        "settings": Settings(**(settings | ({"historical": True} if given.image else {}))),
        "table": given.table,
        "from_zone": given.from_zone,
        "to_zone": given.to_zone,
        "window": (given.from_date, given.to_date) if given.from_date else None,
        "country": given.country,
        "brand": given.brand,
        "months": given.months,
    }


def main(argv: Sequence[str] | None = None) -> None:
    wanted = arguments(argv)
    spark = SparkSession.builder.appName("forecourt").getOrCreate()
    for zone, table in run(tune(spark), **wanted):
        print(f"{zone}: {table}")
    spark.stop()


if __name__ == "__main__":
    main()
