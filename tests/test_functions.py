from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from forecourt.functions import dates, measures, text
from forecourt.functions.amounts import amount, rate, zero_to_null
from forecourt.functions.columns import first_of, key_of, pick, sum_if


def apply(frame, values, function, kind="string"):
    df = frame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", function("v").alias("out")).orderBy("i").collect()]


def test_amount(frame):
    texts = ["1 234,56 EUR", "0", "0,0", "", "-5", "abc", None, "1.2.3", "12-"]
    assert apply(frame, texts, amount) == [1234.56, None, 0.0, None, -5.0, None, None, None, None]


def test_rate(frame):
    assert apply(frame, ["0,20", " 0 , 055 ", "0", "x", None], rate) == [0.2, 0.055, 0.0, None, None]


def test_zero_to_null(frame):
    assert apply(frame, [0.0, None, -1.0, 2.0], zero_to_null, "double") == [None, None, -1.0, 2.0]


def test_parse_date(frame):
    texts = ["2020-01-31", "2020 01 31", "31/01/2020", "01/31/2020", "", None, "31-01-2020"]
    day = date(2020, 1, 31)
    assert apply(frame, texts, dates.parse_date) == [day, day, day, None, None, None, None]


def test_budget_date(frame):
    parsed = apply(frame, ["01/03/20", "x"], lambda c: dates.parse_date(c, ("dd/MM/yy",)))
    assert parsed == [date(2020, 3, 1), None]


def test_cycle(frame):
    df = frame([("B1 2020", "3"), ("B1 2021", "12"), ("B", "3"), ("B1 2020", "13"), (None, None)], "c string, m string")
    out = df.select(dates.cycle_year("c"), dates.cycle_month("c", "m")).collect()
    assert [tuple(r) for r in out] == [
        (2020, date(2020, 3, 1)), (2021, date(2021, 12, 1)), (None, None), (2020, None), (None, None),
    ]


def test_age_bucket(frame):
    ages = [-1, 0, 29, 30, 89, 90, 180, 181, None]
    labels = ["< 0", "[0;30[", "[0;30[", "[30;90[", "[30;90[", "[90;180[", "[90;180[", ">= 180", None]
    assert apply(frame, ages, dates.age_bucket, "int") == labels


def test_ages(frame):
    df = frame([(date(2020, 1, 31), date(2020, 1, 1)), (date(2020, 1, 1), date(2020, 1, 31)), (None, date(2020, 1, 1))], "o date, p date")
    aged = df.withColumn("age", dates.vehicle_age("o", "p"))
    out = aged.select("age", dates.stock_age("age"), dates.delivery_days("o", "p")).collect()
    assert [tuple(r) for r in out] == [(30, 30, -30), (-30, None, 30), (None, None, None)]


def test_promo_label(frame):
    codes = ["", "C", "CX12345", "DX12345", "X1ABCYY", "AB123", "ABCDE6", None, "C12345"]
    assert apply(frame, codes, text.promo_label) == ["", "", "23", "23", "ABC", "1", "CD", None, "3"]


def test_text_rules(frame):
    assert apply(frame, ["CPFR", "PP", None], text.zone_country) == ["FR", "", None]
    assert apply(frame, ["ZONE FRANCE", "one", "ZONE grande bretagne", None], text.country_from_label) == [
        "France", None, "Grande", None,
    ]
    assert apply(frame, ["a", None], text.or_unknown) == ["a", "Unknown"]
    classes = apply(frame, ["Bonus", "Other", None], lambda c: text.classify_heading(c, ["Bonus"]))
    assert classes == [text.NETWORK, text.CLIENT, text.CLIENT]


def test_label(frame):
    df = frame([("fr", "en"), ("fr", None)], "l_fr string, l_en string")
    shown = df.select(text.label("l", "en"), text.label("l", "en", fallback=False), text.label("l")).collect()
    assert [tuple(r) for r in shown] == [("en", "en", "fr"), ("fr", None, "fr")]


def test_pseudonym(frame):
    known = "0cd2a2d2bc43fe1bfcad24d13c16190e748a8aa07cb7491adec9cc9a5b48f6b5"
    assert apply(frame, ["VIN", None], lambda c: text.pseudonym(c, "-VME")) == [known, None]


def test_keys_and_choices(frame):
    df = frame([("a", None, 1), ("a", "b", 63), (None, "b", None)], "x string, y string, n int")
    out = df.select(
        key_of("x", "y"), key_of("x", "n", sep="_"), first_of("x", "y"), pick(F.col("n").isin(1, 63), "x", "y")
    ).collect()
    assert [tuple(r) for r in out] == [
        (None, "a_1", "a", "a"), ("a b", "a_63", "a", "a"), (None, None, "b", "b"),
    ]
    assert df.agg(sum_if(F.col("x").isNotNull(), "n")).first()[0] == 64


@pytest.mark.parametrize(
    ("country", "discount", "aid", "valuation", "repurchase", "expected"),
    [
        ("F", None, None, None, None, (0, 0, 0)),
        ("F", -5.0, None, None, None, (1, 0, 1)),
        ("F", 5.0, 0.0, 0.0, 0.0, (1, 0, 1)),
        ("F", -5.0, 3.0, None, None, (0, 0, 0)),
        ("F", -5.0, 3.0, None, 2.0, (0, 1, 1)),
        ("F", -5.0, None, 3.0, 2.0, (0, 0, 0)),
        ("F", 0.0, 3.0, 1.0, 2.0, (0, 0, 0)),
        ("F", -5.0, -3.0, None, 2.0, (1, 0, 1)),
        ("Spain", -5.0, 3.0, 1.0, 2.0, (0, 0, 1)),
        ("Spain", None, None, None, None, (0, 0, 1)),
    ],
)
def test_discount_flags(frame, country, discount, aid, valuation, repurchase, expected):
    df = frame(
        [(country, discount, aid, valuation, repurchase)],
        "country string, discount_before_tax double, trade_in_aid double, trade_in_valuation double, "
        "repurchase_before_tax double",
    )
    flags = measures.discount_flags(df, "Spain").select("discount_only", "discount_with_trade_in", "usable")
    assert tuple(flags.first()) == expected


def test_advantages(frame):
    df = frame(
        [(-100.0, 20.0, 0.2), (None, None, 0.2), (-50.0, None, None)],
        "total_discount double, trade_in_aid double, tax_rate double",
    )
    out = measures.advantages(df).select("advantage_after_tax", "advantage_before_tax", "trade_in_aid_before_tax")
    assert [tuple(r) for r in out.collect()] == [(120.0, 100.0, 20.0 / 1.2), (None, None, None), (50.0, None, None)]


def test_prices(frame):
    df = frame([(100.0, 20.0, 10.0, 0.25, 0.1), (100.0, None, 10.0, 0.25, None)], "d double, a double, b double, r double, m double")
    out = df.select(
        measures.net_of_tax("d", "r"),
        measures.dealer_margin("d", "a", "b", "r"),
        measures.tariff_with_options("d", "a"),
        measures.list_price("d", "m"),
        measures.fixed_margin_amount("d", "m"),
    ).collect()
    assert [tuple(r) for r in out] == [(80.0, 124.0, 120.0, pytest.approx(110.0), 10.0), (80.0, None, None, None, None)]


def test_net_of_impossible_tax(frame):
    df = frame([(100.0, -1.0)], "d double, r double")
    assert df.select(measures.net_of_tax("d", "r")).first()[0] is None


def test_totals(frame):
    df = frame([(2.0, None, 3.0)], "a double, b double, volume double")
    assert tuple(df.select(*(c.alias(n) for n, c in measures.totals(["a", "b"], "volume").items())).first()) == (6.0, None)
