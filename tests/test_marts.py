"""Marts on hand-made frames."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from forecourt import fixed_values as fixed
from forecourt.plans import layouts
from forecourt.plans.budget import budget, budget_lines
from forecourt.plans.cost_rows import cost_rows
from forecourt.plans.dealers import dealers
from forecourt.plans.engines import engine_lines, engines
from forecourt.plans.forecast import forecast
from forecourt.plans.offers import latest_offers, offers
from forecourt.plans.promo_reference import promo_reference
from forecourt.plans.publication import pseudonymise
from forecourt.plans.references import tax_rates
from forecourt.plans.vehicle_cost import vehicle_cost
from forecourt.plans.vehicle_sales import vehicle_rollup, vehicle_sales
from tests.conftest import rows


def test_rollup_sums_everything_and_shows_the_earliest(frame):
    df = frame(
        [("V", "F", date(2020, 2, 1), "late", 5.0, 1.0), ("V", "F", date(2020, 1, 1), "early", 7.0, -1.0), ("V", "G", None, "g", 0.0, 2.0)],
        "vehicle string, country string, sale_date date, label string, price double, storage_cost double",
    )
    out = vehicle_rollup(df, ["price", "storage_cost"], ["label"])
    assert rows(out) == [("V", "F", "early", 12.0, 0.0), ("V", "G", "g", None, 2.0)]


def test_vehicle_sales_names_and_prices(frame):
    sold = frame(
        [("V", "F", "A", date(2020, 1, 1), "VD", "208 X", "SEGMENT B", "2020 F v", 100.0), ("W", "F", "A", date(2020, 1, 1), "??", "Z", None, "k", 0.0)],
        "vehicle string, country string, brand string, sale_date date, major_client_type_label string, family_label string, "
        "segment_label string, margin_key string, price double",
    )
    out = vehicle_sales(
        sold,
        frame([("VD", "Demo"), (None, "x")], "sales_name string, channel string"),
        frame([("208 X", "208")], "family_to_map string, family string"),
        frame([("2020 F v", "0,1")], "key string, margin string"),
        measures=["price"],
    )
    shown = ("vehicle", "major_client_type_label", "family_label", "segment_label", "fixed_margin", "list_price", "price")
    assert rows(out, *shown) == [
        ("V", "Demo", "208", "B", 0.1, pytest.approx(110.0), 100.0), ("W", "??", "Z", None, None, None, None),
    ]


def offer_frame(frame, *offers_given):
    names = layouts.OFFER_COLUMNS
    schema = ", ".join(f"{n} string" for n in names)
    return frame([tuple(o.get(n) for n in names) for o in offers_given], schema)


def test_offers_keep_latest_and_parse(frame):
    extract = offer_frame(
        frame,
        {"vehicle": "V", "country": "France", "order_date": "2020-01-01", "final_price": "1"},
        {
            "vehicle": "V", "country": "France", "order_date": "03/02/2020", "final_price": "1 200,00 EUR", "tariff": "10",
            "options": "2", "discount_before_tax": "-50", "trade_in_aid": "12", "conversion_bonus": "12", "total_discount": "0",
        },
        {"vehicle": "V", "country": "France", "order_date": "n/a", "final_price": "3"},
        {"vehicle": " " * 17, "country": "France", "order_date": "2021-01-01"},
        {"vehicle": "W", "country": "Nowhere", "final_price": "5"},
    )
    tax = tax_rates(frame([("France", "0,20")], "country string, tax_rate string"))
    assert latest_offers(extract).count() == 2
    out = {r.vehicle: r for r in offers(extract, tax).collect()}
    v = out["V"]
    assert (v.order_date, v.final_price, v.final_price_before_tax) == (date(2020, 2, 3), 1200.0, 1000.0)
    assert (v.tariff_and_options, v.total_discount, v.discount_before_tax) == (12.0, None, 50.0)
    assert v.dealer_margin == pytest.approx(70.0)
    assert (out["W"].final_price, out["W"].final_price_before_tax) == (5.0, None)


def test_vehicle_cost(frame):
    sold = frame(
        [("V", "France", "A", date(2020, 1, 10), "PRIV", "2020", 100.0), ("W", "Spain", "A", date(2020, 1, 5), "CO", "2020", 50.0)],
        "vehicle string, country string, brand string, sale_date date, usage string, year string, price double",
    )
    lines = frame(
        [
            ("V", "France", "Z", None, date(2020, 1, 1), "REG", date(2019, 12, 2)),
            ("V", "France", "Y", None, date(2020, 1, 1), "REG", date(2019, 12, 2)),
            ("V", "Spain", "Z", date(2020, 1, 9), None, None, None),
        ],
        "vehicle string, country string, brand string, sale_date date, order_date date, usage string, production_date date",
    )
    bids = frame(
        [("W", "Spain", date(2020, 1, 2), -10.0, 5.0, 1.0, None, 1.0)],
        "vehicle string, country string, order_date date, total_discount double, trade_in_aid double, "
        "discount_before_tax double, trade_in_valuation double, repurchase_before_tax double",
    )
    tax = frame([("Spain", 0.5)], "country string, tax_rate double")
    out = vehicle_cost(sold, lines, bids, tax)
    assert not {"year", "tax_rate", "total_discount", "sold_sale_date"} & set(out.columns)
    shown = (
        "vehicle", "country", "brand", "sale_date", "order_date", "usage", "vehicle_age", "age_bucket", "delivery_days",
        "advantage_after_tax", "advantage_before_tax", "usable",
    )
    assert rows(out, *shown) == [
        ("V", "France", "A", date(2020, 1, 10), date(2020, 1, 1), "REG", 30, "[30;90[", 9, None, None, 0),
        ("W", "Spain", "A", date(2020, 1, 5), date(2020, 1, 2), "CO", None, None, 3, 15.0, 10.0, 1),
    ]


def test_cost_rows_and_reference(frame):
    names, network = fixed.issued("G")
    sales = frame(
        [
            ("V", "France", "AP", "Op", "R1", "PRIME QUALITE", "O1", 5.0),
            ("V", "France", "AP", "Op", "R1", "PRIME QUALITE", "O1", 5.0),
            ("V", "France", "AP", None, None, None, None, 7.0),
            ("V", "France", "AP", "Zero", "R1", "x", "O2", 0.0),
            ("V", "France", "AP", "None", "R1", "x", "O2", None),
        ],
        "vehicle string, country string, brand string, operation_label string, heading_code string, heading_label string, "
        "operation_code string, promo_cost double",
    )
    vehicles = frame(
        [("V", "France", "AP", 3.0, 100.0, 0.1)],
        "vehicle string, country string, brand string, storage_cost double, list_price double, fixed_margin double",
    )
    costs = cost_rows(sales, vehicles, names, network)
    assert rows(costs, "operation_label", "heading_label", "promo_cost") == [
        ("Financing Costs - Client Promotions", "Financing Costs", 3.0),
        ("Fixed Margin - Client Promotions", "Fixed Margin", 10.0),
        ("Op - Network Remuneration", "G - Bonus for quality", 5.0),
        ("Unknown - Client Promotions", None, 7.0),
    ]
    reference = promo_reference(
        frame([("Op", "Cat N", "France", "AP"), ("Other", None, "France", "AP")], "operation_label string, category string, country string, brand string"),
        frame([("Cat N", "Network Remuneration"), ("Cat N", "Client Promotions"), ("x", "y")], "category string, class string"),
        costs,
        frame([("France",), ("Spain",)], "country string"),
        ["AP", "AC"],
        network,
    )
    found = rows(reference.filter("country = 'France' and brand = 'AP'"), "operation_label", "category")
    assert found == [
        ("Financing Costs - Client Promotions", "To be flagged - Client Promotions"),
        ("Financing Costs - Financing Costs", "FINANCING COSTS"),
        ("Fixed Margin - Client Promotions", "To be flagged - Client Promotions"),
        ("Fixed Margin - Fixed Margin", "FIXED MARGIN"),
        ("Op - Client Promotions", "Cat N"),
        ("Op - Network Remuneration", "To be flagged - Network Remuneration"),
        ("Other - Other", None),
        ("Unknown - Client Promotions", "Unknown - Client Promotions"),
        ("Unknown - Network Remuneration", "Unknown - Network Remuneration"),
    ]
    assert reference.filter("country = 'Spain'").count() == 8


def test_forecast(frame):
    line = ("C 2020", "3", "VIP", " B2C ", "2", "10.5", "7")
    lines = [line, line, ("C 2020", "3", "VIP", "B2G", "2", "1", "1"), ("C x", "3", "??", "B 2B", "x", "1", "1")]
    kind = "cycle string, month string, client_type string, channel string, volume string, rm035 string, price string"
    ref = frame([("VIP", "Fleet")], "forecast_name string, channel string")
    out = forecast(frame(lines, kind), ref, ["rm035"], ["price"])
    assert rows(out, "client_type", "year", "date", "volume", "rm035_total") == [
        ("??", None, None, None, None), ("Fleet", 2020, date(2020, 3, 1), 2.0, 21.0),
    ]
    assert "channel" not in out.columns


def test_budget(frame):
    kind = "brand string, country string, vehicle_type string, family string, energy string, channel string, volume string, date string, year string"
    sheets = [
        frame([("MAKE", "FRANCE", "VP", "208 X", "(vide)", "VD/VA", "1 000,5", "01/02/20", "2020")] * 2, kind),
        frame([("DS", "PAYS BAS", "AJUST", "f", "e", "c", "1", "x", "y"), ("DS", "PAYS BAS", None, "f", "e", "c", "1", "x", "y")], kind),
    ]
    out = budget(
        budget_lines(sheets, {"MAKE": "AC"}),
        frame([("208 X", "208")], "family_to_map string, family string"),
        frame([("VD/VA", "Demo")], "budget_name string, channel string"),
        ["volume"],
    )
    assert rows(out) == [("AC", "France", "PC", "208", "", "Demo", 1000.5, date(2020, 2, 1), 2020)]


def test_dealers(frame):
    df = frame([("P", " S1 "), ("P", "S1"), ("S", "S2"), (None, "S3")], "rank string, sector_code string")
    assert rows(dealers(df)) == [("P", "S1")]


def test_engines(frame):
    models = frame(
        [("E1", "1", "DIESEL"), ("E1", "1", "Diesel"), ("E2", "1", ""), ("E2", "1", "Gasolina?"), ("E3", "1", "ESSENCE"), ("E3", "1", "ELECTRICO"), ("E4", "9", "DIESEL")],
        "engine string, affiliate string, energy string",
    )
    countries = frame([("1", "Pays Bas"), ("9", "Suisse")], "affiliate string, country_label string")
    lines = engine_lines(models, countries)
    assert rows(engines(lines)) == [("E1", "Netherlands", "Diesel"), ("E2", "Netherlands", "Gasolina"), ("E3", "Netherlands", "Unknown")]
    assert engine_lines(models, countries, country="France").count() == 0


def test_pseudonyms_stay_joinable(frame):
    a, b = (pseudonymise(frame([("V", i)], "vehicle string, n int"), ["vehicle"], "s") for i in (1, 2))
    assert a.join(b, "vehicle").count() == 1
    assert a.filter(F.length("vehicle") == 64).count() == 1


def test_layouts_agree():
    assert set(layouts.OFFERS["FR"].output) == set(layouts.OFFERS["SP"].output) == set(layouts.OFFER_COLUMNS)
    assert len(layouts.OFFER_COLUMNS) == 28 and len(layouts.BUDGET.columns) == 27 and len(layouts.DEALERS.columns) == 15
    assert len(layouts.forecast("x").columns) == 26 and len(layouts.SALES_TABLES["facts"]) == 42
