"""A whole run over a small copy of both systems and all delivered files."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from forecourt.__main__ import arguments
from forecourt.plans import layouts, publication
from forecourt.plans.ledger import Ledger
from forecourt.plans.run import Run, Settings, Step, in_months, needed, requests, run
from forecourt.sources.zones import read_zone, write_zone
from tests.conftest import rows

WINDOW = (date(2020, 1, 1), date(2020, 3, 31))
D = date(2020, 2, 1)


def table(spark, folder, columns, given):
    """Write a source table; columns not given are empty text."""
    kinds = {"date": "date", "int": "bigint", "float": "double", "str": "string"}
    names = {ours: theirs for theirs, ours in columns.items()}
    first = given[0]
    schema = ", ".join(f"`{names[c]}` {kinds[type(first.get(c, '')).__name__]}" for c in names)
    data = [tuple(row.get(c) for c in names) for row in given]
    write_zone(spark.createDataFrame(data, schema), folder)


def registration(spark, folder):
    line = {
        "vehicle": "VIN1", "order_date": date(2020, 1, 20), "sale_date": D, "usage": "P", "co2": 100.0, "engine": "E1",
        "affiliate": "1", "order_no": "N1", "profession": "10", "vehicle_type": "VP", "version_code": "208XLONG",
    }
    tables = {
        "lines": [line, line | {"vehicle": "VIN2", "affiliate": "2", "order_no": "N2"}, line | {"sale_date": date(2019, 1, 1)}],
        "countries": [{"affiliate": "1", "country_label": "France"}, {"affiliate": "2", "country_label": "Espagne"}],
        "affiliates": [{"affiliate": "1"}, {"affiliate": "2"}],
        "orders": [{"affiliate": "1", "order_no": "N1", "operation_1": "CX12345", "promo": "0", "discount_percent": "0"}],
        "engines": [{"engine": "E1", "affiliate": "1", "energy": "DIESEL"}],
        "vehicles": [{"affiliate": "1", "vehicle": "VIN1", "registered_on": date(2020, 2, 5), "production_date": date(2019, 12, 1)}],
        "usages": [{"usage": "P", "affiliate": "1"}],
        "packs": [{"affiliate": "1", "pack": "x", "version": "y", "pack_label": "z"}],
        "financing": [{"file_no": "x", "affiliate": "1", "reserved_on": D}],
        "movements": [{"affiliate": "1", "vehicle": "VIN1", "registered_on": date(2020, 2, 9)}],
        "professions": [{"code": "10", "label": "Baker"}, {"code": "10", "label": "Clerk"}],
        "families": [{"affiliate": "83", "vehicle_type": "VP", "family": "208X", "family_label": "208", "brand": "AP"}],
    }
    for name, given in tables.items():
        table(spark, f"{folder}/registration/{name}", layouts.REGISTRATION_TABLES[name], given)


def sales_system(spark, folder):
    facts = {c: 1 for c in layouts.SALES_TABLES["facts"].values() if c.endswith("_id")}
    measures = ("volume", "price", "options_price", "version_price", "margin", "margin_option", "entity_margin_version", "net_revenue", "promo_cost", "storage_cost")
    others = ("price_raw", "margin_raw", "margin_version", "entity_margin_raw", "entity_margin", "entity_margin_option")
    fact = facts | dict.fromkeys((*measures, *others), 1.0) | {
        "price": 100.0, "sale_date": D, "invoice_date": D, "order_date": D, "registered_on": D, "usage": "Q", "promo_cost": 5.0,
    }
    spain = fact | {"zone_id": 2, "vehicle_id": 2, "heading_id": 9, "operation_id": 9, "segment_id": 9}
    given = [fact, fact, spain, fact | {"base_id": 2}, fact | {"zone_id": 3}, fact | {"sale_date": date(2021, 1, 1)}]
    table(spark, f"{folder}/sales/facts", layouts.SALES_TABLES["facts"], given)
    codes = {
        "zone": ("CPFR", "PPES", "XXFR"), "base": ("LA", "EA", "EA"), "vehicle": ("VIN1", "VIN2", "VIN3"),
        "brand": ("AP", "AP", "AP"), "heading": ("R1", "R2", "R3"), "operation": ("O1", "O2", "O3"),
        "channel": ("C", "C", "C"), "major_client_type": ("M", "M", "M"), "minor_client_type": ("m", "m", "m"), "version": ("v", "v", "v"),
    }
    labels = {"heading": "PRIME QUALITE", "operation": "Spring", "segment": "SEGMENT B", "family": "208 X", "major_client_type": "VD"}
    for name, columns in layouts.SALES_TABLES.items():
        if name == "facts":
            continue
        shared = "zone_id" not in columns.values()
        rows_ = []
        for i, code in enumerate(codes.get(name, ("c", "c", "c")), start=1):
            for zone in (1,) if shared else (1, 2, 3):
                row = {"id": i, "code": code, "zone_id": zone, "group_id": 1, "brand_id": 1, "label_fr": labels.get(name, name)}
                rows_.append({c: v for c, v in row.items() if c in columns.values()})
        table(spark, f"{folder}/sales/{name}", columns, rows_)


def files(folder):
    def put(name, header, *lines):
        text = "\n".join([";".join(header), *(";".join(line) for line in lines)]) + "\n"
        (folder / name).write_bytes(text.encode("iso-8859-1"))

    def delivered(name, spec, *given):
        heads = [h for h, ours in spec.columns.items() if ours != "country" or "country" not in spec.columns]
        put(name, heads, *([row.get(spec.columns[h], "") for h in heads] for row in given))

    offer = {"vehicle": "VIN1", "brand": "AP", "order_date": "2020-01-15", "total_discount": "-120", "final_price": "1200", "discount_before_tax": "-100"}
    delivered("offers_FR_1.csv", layouts.OFFERS["FR"], offer, offer | {"order_date": "2020 01 10", "total_discount": "-1"})
    delivered("offers_SP_1.csv", layouts.OFFERS["SP"], {"vehicle": "VIN2", "brand": "AP", "order_date": "15/01/2020"})
    for code in ("FR", "SP"):
        put(f"promotions_{code}_1.csv", ["Brand", "Opc", "Category"], ["AP", "Spring", "Cat"])
    put("classes.csv", ["VME Category", "Classification"], ["Cat", "Network Remuneration"])
    put("channel_types.csv", list(layouts.CHANNEL_TYPES.columns), ["FR AP C M m", "Direct"], ["ES AP C M m", "Direct"])
    put("margins.csv", ["Key Margin", "Marge_u"], ["2020 FR v", "0,1"])
    put("channels.csv", ["channel", "forecast_lib", "sales_lib", "budget_lib"], ["Demo", "VIP", "VD", "VD/VA"])
    put("families.csv", ["family", "Brand", "familytomap"], ["208", "AP", "208 X"])
    put("tax_rates.csv", ["country", "taxrate"], ["France", "0,20"], ["Spain", "0,21"])
    put("category_order.csv", ["Client promotions", "Order"], ["Cat", "1"])
    put("dealers.csv", list(layouts.DEALERS.columns), ["FRANCE", "AP", *["x"] * 9, " S1 ", "y", "z", "P"])
    budget = {"brand": "MAKE", "country": "FRANCE", "vehicle_type": "VP", "volume": "1,5", "date": "01/02/20", "year": "2020"}
    put("budget_2020.csv", list(layouts.BUDGET.columns), [budget.get(c, "") for c in layouts.BUDGET.columns.values()])
    forecast = layouts.forecast("LIBELLE_SOUSFAMILLE").columns
    line = {"country": "FRANCE", "brand": "AP", "cycle": "C 2020", "month": "3", "channel": "B2C", "volume": "2", "rm035": "10"}
    put("forecast_1.csv", [h.replace("_", " ") if h != "Finition_Commerce" else h for h in forecast], [line.get(c, "1") for c in forecast.values()])


@pytest.fixture(scope="module")
def delivered(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("delivered")
    registration(spark, str(folder))
    sales_system(spark, str(folder))
    (folder / "files").mkdir()
    files(folder / "files")
    return folder


@pytest.fixture()
def settings_of(delivered, tmp_path):
    return Settings(
        root=str(tmp_path / "zones"),
        source=str(delivered),
        extracts=str(delivered / "files"),
        database="jdbc:none",
        issuer="G",
        brand_names={"MAKE": "AP"},
        historical=True,
    )


def test_everything(spark, settings_of, monkeypatch):
    published = {}
    monkeypatch.setattr(publication, "publish_jdbc", lambda df, url, table, *a, **k: published.update({table: df}))
    done = run(spark, settings_of, window=WINDOW, now=datetime(2020, 4, 1))
    assert done[0] == ("raw", "all") and done[-1][0] == "published"
    assert len(done) == len(set(done))
    refined = lambda name: read_zone(spark, f"{settings_of.root}/refined/{name}")

    cost = {r.vehicle: r for r in refined("vehicle_cost").collect()}
    assert set(cost) == {"VIN1", "VIN2"}
    one, two = cost["VIN1"], cost["VIN2"]
    assert (one.country, one.brand, one.price, one.list_price) == ("France", "AP", 200.0, pytest.approx(220.0))
    assert (one.sale_date, one.order_date, one.usage, one.co2) == (D, date(2020, 1, 20), "P", 100.0)
    assert (one.sold_order_date, one.registered_on) == (D, D)
    assert (one.vehicle_age, one.age_bucket, one.delivery_days) == (50, "[30;90[", 12)
    assert (one.advantage_after_tax, one.advantage_before_tax) == (120.0, 100.0)
    assert (one.major_client_type_label, one.family_label, one.segment_label) == ("Demo", "208", "B")
    assert (one.operation_1_label, one.profession_label, one.vehicle_type) == ("23", "Clerk", "PC")
    assert one.registration_registered_on == date(2020, 2, 9)
    assert (two.country, two.usable, two.list_price, two.segment_label) == ("Spain", 1, None, None)

    assert rows(refined("cost_rows").filter("vehicle = 'VIN1'"), "operation_label", "promo_cost") == [
        ("Financing Costs - Client Promotions", 2.0),
        ("Fixed Margin - Client Promotions", pytest.approx(22.0)),
        ("Spring - Network Remuneration", 10.0),
    ]
    promos = refined("promo_reference").filter("country = 'France' and brand = 'AP'")
    assert ("Spring - Network Remuneration", "Cat") in rows(promos, "operation_label", "category")
    assert rows(refined("engines"), "engine", "energy", "country") == [("E1", "Diesel", "France")]
    assert rows(refined("budget"), "brand", "country", "vehicle_type", "volume") == [("AP", "France", "PC", 1.5)]
    assert rows(refined("forecast"), "country", "rm035_total", "date") == [("France", 20.0, date(2020, 3, 1))]
    assert rows(refined("dealers"), "country", "sector_code") == [("France", "S1")]
    assert rows(refined("tax_rates"), "country", "tax_rate") == [("France", 0.2), ("Spain", 0.21)]
    assert refined("sale_calendar").count() == refined("order_calendar").count() == 91
    assert rows(refined("channels")) == [("Demo",)]

    assert "vehicle_sales" not in published and len(published) == 14
    assert all(len(r.vehicle) == 64 for r in published["cost_rows"].collect())
    images = spark.read.parquet(f"{settings_of.root}/historical/sales/image_as_of=2020-04-01_00-00-00/facts")
    assert images.count() == 5


def test_one_table_one_country(spark, settings_of):
    run(spark, settings_of, to_zone="refined", window=WINDOW)
    before = read_zone(spark, f"{settings_of.root}/refined/vehicle_cost").filter("country = 'Spain'").collect()
    done = run(spark, settings_of, "vehicle_cost", "raw", "refined", WINDOW, country="FR", brand="AP")
    assert [table for zone, table in done if zone == "refined"] == ["tax_rates", "vehicle_sales", "offers", "vehicle_cost"][1:]
    assert {"registrations", "sales", "offers", "margins", "channels", "families", "tax_rates"} <= {t for z, t in done if z == "standard"}
    after = read_zone(spark, f"{settings_of.root}/refined/vehicle_cost")
    assert after.filter("country = 'Spain'").collect() == before
    assert after.count() == 2


@pytest.mark.parametrize("name", ["vehicle_cost", "promo_reference", "budget"])
def test_every_request_runs_alone(spark, settings_of, name):
    """From an empty root to the refined zone, whatever the mart."""
    done = run(spark, settings_of, name, "source", "refined", WINDOW, now=datetime(2020, 4, 1))
    assert done and all(read_zone(spark, f"{settings_of.root}/{z}/{t}").columns for z, t in done if z != "raw")


def test_requests_name_what_they_rest_on():
    assert needed("promo_reference") >= {"raw.sales", "standard.channel_types", "standard.margins", "refined.cost_rows"}
    assert needed("budget") == {"standard.budget", "standard.families", "standard.channels", "refined.budget"}
    for name in requests():
        assert needed(name)


def test_later_run_replaces_the_tables(spark, settings_of):
    """Rows of an earlier window don't stay behind, also if the new window has none."""
    empty = (date(2018, 1, 1), date(2018, 1, 31))
    run(spark, settings_of, "vehicle_cost", "source", "refined", WINDOW, now=datetime(2020, 4, 1))
    cost = lambda: read_zone(spark, f"{settings_of.root}/refined/vehicle_cost")
    assert cost().count() == 2
    run(spark, settings_of, "vehicle_cost", "source", "refined", empty, country="ES", now=datetime(2020, 4, 2))
    assert rows(cost(), "country") == [("France",)]
    run(spark, settings_of, "vehicle_cost", "source", "refined", empty, now=datetime(2020, 4, 3))
    assert cost().count() == 0


MONTHS = (date(2020, 1, 1), date(2020, 1, 1))


def more_months(spark, source):
    """Both systems with vehicles of two more months."""
    registration(spark, str(source))
    sales_system(spark, str(source))
    facts = spark.read.parquet(f"{source}/sales/facts")
    names = {ours: theirs for theirs, ours in layouts.SALES_TABLES["facts"].items()}
    days = [names[c] for c in ("sale_date", "invoice_date", "order_date", "registered_on")]
    shifted = [facts.withColumns({c: F.add_months(c, k) for c in days}) for k in (-1, 1)]
    write_zone(facts.unionAll(shifted[0]).unionAll(shifted[1]), f"{source}/sales/facts")


@pytest.fixture(scope="module")
def three_months(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("months")
    more_months(spark, folder)
    return str(folder)


def months_of_mart(spark, settings, name):
    return {r.sale_date.month for r in read_zone(spark, f"{settings.root}/refined/{name}").select("sale_date").collect()}


def test_back_fill_leaves_other_months_alone(spark, settings_of, three_months):
    settings = replace(settings_of, source=three_months, historical=False)
    cost = Path(settings.root) / "refined" / "vehicle_cost"
    files_of = lambda: {p.name: sorted(f.name for f in p.rglob("*.parquet")) for p in cost.glob("period=*")}
    prices = lambda: rows(read_zone(spark, str(cost)).groupBy("period").agg(F.sum("price")))
    run(spark, settings, "vehicle_cost", "source", "refined", MONTHS, months=3)
    assert months_of_mart(spark, settings, "vehicle_cost") == {1, 2, 3}
    assert "period" not in Run(spark, settings, MONTHS).read("refined", "vehicle_cost").columns
    assert prices() == [(202001, 300.0), (202002, 300.0), (202003, 300.0)]
    before = files_of()
    run(spark, settings, "vehicle_cost", "source", "refined", (D, D), months=1)
    after = files_of()
    assert [after[f"period={p}"] == before[f"period={p}"] for p in (202001, 202002, 202003)] == [True, False, True]
    assert prices() == [(202001, 300.0), (202002, 300.0), (202003, 300.0)]


def test_back_fill_of_costs_and_calendars(spark, settings_of, three_months):
    settings = replace(settings_of, source=three_months, historical=False)
    found = lambda name: read_zone(spark, f"{settings.root}/refined/{name}")
    run(spark, settings, "promo_reference", "source", "refined", MONTHS, months=2)
    assert {r.period for r in found("cost_rows").select("period").collect()} == {202001, 202002}
    promos = rows(found("promo_reference").filter("brand = 'AP'"), "operation_label", "country")
    assert ("Spring - Network Remuneration", "France") in promos
    for months, days in ((3, 91), (1, 91)):
        run(spark, settings, "sale_calendar", "source", "refined", MONTHS, months=months)
        assert found("sale_calendar").count() == days


def test_a_month_without_rows_ends_up_empty(spark, settings_of, three_months):
    settings = replace(settings_of, source=three_months, historical=False)
    run(spark, settings, "sales", "source", "refined", MONTHS, months=2)
    only_february = settings.source + "-less"
    registration(spark, only_february)
    sales_system(spark, only_february)
    run(spark, replace(settings, source=only_february), "sales", "source", "refined", MONTHS, months=1)
    assert months_of_mart(spark, settings, "vehicle_sales") == {2}


def failing_once(monkeypatch, step_name, period=None):
    """Let the writing of one step fail the first time."""
    left, write = [1], Step.write

    def once(self, run, only):
        if self.name == step_name and (period is None or run.period == period) and left:
            left.pop()
            raise ConnectionError("driver lost")
        write(self, run, only)

    monkeypatch.setattr(Step, "write", once)


def test_an_interrupted_back_fill_resumes(spark, settings_of, three_months, monkeypatch):
    settings = replace(settings_of, source=three_months, historical=False)
    failing_once(monkeypatch, "refined.vehicle_sales", 202002)
    with pytest.raises(ConnectionError):
        run(spark, settings, "sales", "source", "refined", MONTHS, months=2)
    assert months_of_mart(spark, settings, "vehicle_sales") == {1}
    done = run(spark, settings, "sales", "source", "refined", MONTHS, months=2)
    assert months_of_mart(spark, settings, "vehicle_sales") == {1, 2}
    assert done == [("refined", "vehicle_sales")]
    assert not list((Path(settings.root) / ".runs").glob("*.json"))  # a finished run leaves nothing to go on with


def test_a_run_goes_on_at_the_failed_step(spark, settings_of, delivered, monkeypatch):
    settings = replace(settings_of, historical=False)
    failing_once(monkeypatch, "refined.vehicle_cost")
    with pytest.raises(ConnectionError):
        run(spark, settings, "vehicle_cost", "source", "refined", WINDOW)
    sales = f"{settings.root}/standard/sales"
    write_zone(read_zone(spark, sales).withColumn("price", F.lit(7.0)), sales, ("period", "country", "brand"))
    done = run(spark, settings, "vehicle_cost", "source", "refined", WINDOW)
    # the changed table is built again, and what reads it; the rest stands
    assert done == [("standard", "sales"), ("refined", "vehicle_sales"), ("refined", "vehicle_cost")]
    assert {r.price for r in read_zone(spark, f"{settings.root}/refined/vehicle_cost").collect()} == {100.0, 200.0}


def test_other_requests_and_inputs_have_their_own_ledger(spark, tmp_path):
    root, path = str(tmp_path), str(tmp_path / "t")
    write_zone(spark.range(3), path)
    ledger = Ledger(spark, root, {"table": "a"})
    ledger.record("x", [path], ())
    assert Ledger(spark, root, {"table": "a"}).done("x", [path], ())
    assert not Ledger(spark, root, {"table": "b"}).done("x", [path], ())
    write_zone(spark.range(3), path)
    assert not Ledger(spark, root, {"table": "a"}).done("x", [path], ())
    ledger.close()
    assert not Ledger(spark, root, {"table": "a"}).done("x", [path], ())


def test_professions_under_other_headers(spark, settings_of, delivered, tmp_path):
    source = tmp_path / "systems"
    registration(spark, str(source))
    folder = f"{source}/registration/professions"
    renamed = [("10", "Smith")]
    write_zone(spark.createDataFrame(renamed, "CODPROF string, LIBPROF string"), folder)
    settings = replace(settings_of, source=str(source), profession_headers=("CODPROF", "LIBPROF"))
    run(spark, settings, "registrations", "source", "standard", WINDOW)
    found = read_zone(spark, f"{settings.root}/standard/registrations")
    assert "Smith" in {r.profession_label for r in found.collect()}


def test_facts_are_landed_by_month(spark, settings_of):
    run(spark, settings_of, "sales", "source", "raw", (date(2020, 2, 10), date(2020, 2, 12)))
    landed = spark.read.parquet(f"{settings_of.root}/raw/sales/facts")
    assert {(r.year, r.month) for r in landed.collect()} == {(2020, 2)}
    run(spark, settings_of, "sales", "source", "raw", (date(2020, 12, 1), date(2020, 12, 1)), months=2)
    assert {(r.year, r.month) for r in spark.read.parquet(f"{settings_of.root}/raw/sales/facts").collect()} == {(2020, 2), (2021, 1)}
    pruned = spark.read.parquet(f"{settings_of.root}/raw/sales/facts").filter(in_months(WINDOW))
    assert "PartitionFilters: [isnotnull" in pruned._jdf.queryExecution().toString()


def test_unchanged_months_are_not_landed_again(spark, settings_of, three_months):
    settings = replace(settings_of, source=three_months, historical=False)
    facts = Path(settings.root) / "raw" / "sales" / "facts"
    files_of = lambda: {p.name: p.stat().st_mtime_ns for p in facts.rglob("*.parquet")}
    run(spark, settings, "sales", "source", "raw", MONTHS, months=2)
    before = files_of()
    run(spark, settings, "sales", "source", "raw", MONTHS, months=3)
    assert before.items() < files_of().items()


def test_command_line(tmp_path, capsys):
    file = tmp_path / "settings.json"
    file.write_text(json.dumps({"root": "r", "source": "s", "extracts": "e", "brands": ["AP"]}))
    given = arguments(
        ["--settings", str(file), "--table", "offers", "--to-zone", "refined", "--country", "FR"]
        + ["--from-date", "01/02/2020", "--to-date", "29/02/2020"]
    )
    assert given["window"] == (date(2020, 2, 1), date(2020, 2, 29))
    assert (given["table"], given["from_zone"], given["country"], given["brand"]) == ("offers", "source", "FR", None)
    assert given["settings"].historical is False and given["months"] is None
    filled = arguments(["--settings", str(file), "--to-zone", "raw", "--from-date", "01/02/2020", "--months", "3", "--image"])
    assert filled["months"] == 3 and filled["window"][0] == date(2020, 2, 1) and filled["settings"].historical
    assert given["settings"].brands == ["AP"]
    assert arguments(["--settings", str(file), "--to-zone", "raw"])["window"] is None
    with pytest.raises(SystemExit):
        arguments(["--settings", str(file), "--to-zone", "raw", "--to-date", "29/02/2020"])
    assert "go together" in capsys.readouterr().err


def test_wrong_requests(spark, settings_of):
    assert {"all", "vehicle_cost", "offers", "sale_calendar"} <= set(requests())
    with pytest.raises(ValueError, match="unknown table"):
        run(spark, settings_of, "nothing")
    with pytest.raises(ValueError, match="unknown zone"):
        run(spark, settings_of, from_zone="nowhere")
