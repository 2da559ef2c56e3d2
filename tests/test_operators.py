from __future__ import annotations

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt.operators import aggregates, duplicates, filters, joins, lookups, rows as row_ops, schema
from forecourt.operators.calendar import calendar, calendar_of
from forecourt.operators.extract import extract
from forecourt.operators.history import last_days, month_windows, reduce_fact
from forecourt.operators.joins import DimSpec, attach
from forecourt.plans.references import ordered_categories
from tests.conftest import rows

# --- schema -------------------------------------------------------------------------


def test_conform(frame):
    df = frame([("1", "2", "3")], "`a b` string, unused string, c string")
    spec = schema.TableSpec({"a b": "x", "c": "y"}, {"z": "double"}, ("z", "y", "x"))
    out = schema.conform(df, spec)
    assert out.columns == ["z", "y", "x"] == list(spec.output)
    assert dict(out.dtypes)["z"] == "double"
    assert rows(out) == [(None, "3", "1")]


def test_conform_rejects_missing_column(frame):
    with pytest.raises(Exception, match="(?i)unresolved"):
        schema.conform(frame([("1",)], "a string"), schema.TableSpec({"b": "x"})).collect()


def test_conform_needs_quoting(frame):
    df = frame([("1",)], "`a.b` string")
    assert rows(schema.conform(df, schema.TableSpec({"a.b": "x"}))) == [("1",)]


def test_clean_headers(frame):
    df = frame([(1, 2, 3, 4)], "` a b ` int, `c\r(d)` int, `e-f` int, `g;=.'h` int")
    assert schema.clean_headers(df).columns == ["a_b", "c_d_", "ef", "g____h"]


def test_cast_and_stringify(frame):
    df = frame([("1", "x", 2.5)], "a string, b string, c double")
    out = schema.cast_all(df, ["a", "b", "c"], "int")
    assert rows(out) == [(1, None, 2)]
    assert schema.stringify(out).dtypes == [("a", "string"), ("b", "string"), ("c", "string")]


def test_union_matches_names(frame):
    a, b = frame([(1, "x")], "n int, t string"), frame([("y", 2)], "t string, n int")
    assert rows(schema.union_all([a, b])) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        schema.union_all([])


# --- filters ------------------------------------------------------------------------


def test_between_dates_includes_both_ends(frame):
    moments = [datetime(2019, 12, 31, 23, 59), datetime(2020, 1, 1), datetime(2020, 1, 31, 23, 59), datetime(2020, 2, 1)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = frame([(m,) for m in moments], f"d {kind}")
        assert filters.between_dates(df, "d", date(2020, 1, 1), date(2020, 1, 31)).count() == 2
    df = frame([(m.date(),) for m in moments], "d date")
    assert filters.between_dates(df, "d", date(2020, 1, 1), date(2020, 1, 31)).count() == 2


def test_between_dates_ignores_time_zones(frame, settings):
    settings(session__timeZone="America/New_York")
    df = frame([(datetime(2020, 1, 1),), (datetime(2020, 1, 31, 23),), (datetime(2020, 2, 1),)], "d timestamp_ntz")
    assert filters.between_dates(df, "d", date(2020, 1, 1), date(2020, 1, 31)).count() == 2


def test_restrict_applies_each_argument(frame):
    df = frame([("F", "A"), ("F", "B"), ("G", "A")], "country string, brand string")
    assert filters.restrict(df).count() == 3
    assert filters.restrict(df, country="F").count() == 2
    assert filters.restrict(df, brand="A").count() == 2
    assert filters.restrict(df, "F", "A").count() == 1


def test_drop_blank_and_nonzero(frame):
    df = frame([(" " * 17, 0.0), ("", None), (None, 1.0), ("V", -1.0)], "v string, n double")
    assert rows(filters.drop_blank(df, "v")) == [("V", -1.0)]
    assert rows(filters.nonzero(df, "n"), "n") == [(-1.0,), (1.0,)]


def test_perimeter_is_half_open(frame):
    opened, closed = date(2031, 5, 4), date(2031, 9, 30)
    passed = [("Lyme", date(2031, 5, 3), "gate 7"), ("Lyme", opened, "gate 7"), ("Lyme", date(2031, 9, 29), "gate 7"), ("Lyme", closed, "gate 7")]
    others = [("Hythe", opened, "gate 7"), ("Lyme", opened, "gate 8"), ("Rye", date(2031, 7, 1), "gate 7")]
    df = frame(passed + others, "site string, pass_date date, door string")
    kept = filters.perimeter(df, ["Lyme", "Rye"], opened, closed, "gate 7")
    assert rows(aggregates.count_by(kept, "site")) == [("Lyme", 2), ("Rye", 1)]


# --- joins and lookups ----------------------------------------------------------------


def test_attach_roles_and_expressions(frame):
    fact = frame([(1, 2, "ABCDX"), (2, 9, None)], "a int, b int, code string")
    names = frame([(1, "one"), (2, "two")], "id int, name string")
    family = frame([("ABCD", "F")], "family string, label string")
    out = attach(
        fact,
        [
            DimSpec(names, {"id": "a"}, role="first"),
            DimSpec(names, {"id": "b"}, "left", role="second"),
            DimSpec(family, {"family": F.substring("code", 1, 4)}, "left"),
        ],
    )
    assert out.columns == ["a", "b", "code", "first_name", "second_name", "label"]
    assert rows(out) == [(1, 2, "ABCDX", "one", "two", "F"), (2, 9, None, "two", None, None)]


@hypothesis_settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(0, 5)), min_size=1, max_size=15), st.booleans())
def test_left_join_with_unique_keys_keeps_every_row(frame, keys, many):
    fact = frame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    dim = frame([(k, f"name {k}") for k in (1, 3, 5)], "k int, name string")
    joined = attach(fact, [DimSpec(dim, ["k"], "left", many=many)])
    assert rows(joined, "i", "name") == sorted(
        ((i, f"name {k}" if k in (1, 3, 5) else None) for i, k in enumerate(keys)), key=repr
    )


def test_attach_rejects_clashes(frame):
    fact = frame([(1, "x")], "id int, name string")
    with pytest.raises(ValueError, match="name"):
        attach(fact, [DimSpec(fact, ["id"])])


def test_attach_label_takes_largest(frame):
    ref = frame([("a", "x"), ("a", "y")], "code string, label string")
    out = joins.attach_label(frame([("a",), ("b",)], "c string"), ref, "c", "code", "label", "shown")
    assert rows(out) == [("a", "y"), ("b", None)]


def test_merge_sources(frame):
    a = frame([(1, "a1", "x"), (2, None, "y")], "k int, d string, only_a string")
    b = frame([(2, "b2", 7), (3, "b3", 8)], "k int, e string, only_b int")
    out = joins.merge_sources(a, b, ["k"], {"d": ("d", "e")})
    assert rows(out, "k", "d", "only_a", "only_b") == [(1, "a1", "x", None), (2, "b2", "y", 7), (3, "b3", None, 8)]


def test_anti_and_semi_cover_input(frame):
    df = frame([(i % 5, i) for i in range(20)], "k int, v int")
    ref = frame([(1,), (1,), (3,)], "k int")
    missing = joins.missing_from(df, ref, ["k"])
    assert missing.count() + df.join(ref, "k", "left_semi").count() == 20
    assert {r.k for r in missing.collect()} == {0, 2, 4}


def test_join_all(frame):
    frames = [frame([(1, i), (i, i)], f"k int, v{i} int") for i in (2, 3)]
    assert rows(joins.join_all(frames, ["k"])) == [(1, 2, 3)]


def test_recode_keeps_unknown_and_null(frame):
    df = frame([("a",), ("z",), (None,)], "c string")
    once = lookups.recode(df, "c", {"a": "b"})
    assert rows(once) == rows(lookups.recode(once, "c", {"a": "b"})) == [("b",), ("z",), (None,)]


def test_lookups(frame):
    df = frame([("a",), ("m",), ("n",), ("z",), (None,)], "c string")
    ref = frame([("a", "1"), ("a", "2"), ("m", None), ("n", "Other"), (None, "9")], "k string, v string")
    assert rows(lookups.recode_from(df, "c", ref, "k", "v")) == [("2",), ("Other",), ("m",), ("z",), (None,)]
    found = lookups.lookup(df, "c", ref, "k", "v", "out")
    assert rows(found) == [("a", "2"), ("m", None), ("n", "Other"), ("z", None), (None, None)]
    assert rows(lookups.ambiguous_keys(ref, "k", "v")) == [("a", "1", "2")]
    assert rows(lookups.keep_mapped(df, "c", ref, "k", "v", "out")) == [("a", "2")]


@hypothesis_settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", "b", "c", None]), min_size=1, max_size=12))
def test_recode_from_keeps_every_row(frame, values):
    df = frame([(v,) for v in values], "c string")
    ref = frame([("a", "x"), ("a", "y"), ("b", "z")], "k string, v string")
    expected = sorted(({"a": "y", "b": "z"}.get(v, v) for v in values), key=repr)
    assert sorted((r.c for r in lookups.recode_from(df, "c", ref, "k", "v").collect()), key=repr) == expected


# --- duplicates -----------------------------------------------------------------------


def test_keep_first_and_latest(frame):
    df = frame(
        [("a", None, 1), ("a", 5, 3), ("a", 5, 2), ("a", 9, 1), ("b", None, 7), (None, 1, 1), (None, 2, 2)],
        "k string, o int, t int",
    )
    assert rows(duplicates.keep_first(df, ["k"], ["o"], ["t"])) == [("a", 5, 2), ("b", None, 7), (None, 1, 1)]
    assert rows(duplicates.keep_latest(df, ["k"], ["o"], ["t"])) == [("a", 9, 1), ("b", None, 7), (None, 2, 2)]
    assert rows(duplicates.keep_first(df, ["k"])) == [("a", None, 1), ("b", None, 7), (None, 1, 1)]
    assert duplicates.keep_first(df, ["k"]).columns == df.columns


@hypothesis_settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 3)), min_size=1, max_size=30))
def test_choice_is_unique_and_stable(frame, values):
    df = frame(values, "k int, o int, t int")
    first = rows(duplicates.keep_first(df, ["k"], ["o"]))
    assert len(first) == len({k for k, _, _ in values})
    assert rows(duplicates.keep_first(frame(values[::-1], "k int, o int, t int"), ["k"], ["o"])) == first
    by_key = {k: min((v for v in values if v[0] == k), key=lambda v: (v[1] is None, v[1] or 0, v[2])) for k, _, _ in values}
    assert first == sorted(by_key.values(), key=repr)


def test_roll_up(frame):
    df = frame([("a", 2, "late", 1.0), ("a", 1, "early", 2.0), ("b", 1, "only", 0.0)], "k string, o int, t string, m double")
    out = duplicates.roll_up(df, ["k"], {"m": F.sum("m")}, ["t", "o"], ["o"])
    assert rows(out) == [("a", "early", 1, 3.0), ("b", "only", 1, 0.0)]


def test_group_count_with_null_key(frame):
    df = frame([("a", 1), ("a", 2), (None, 3), (None, 4), ("b", 5)], "k string, v int")
    assert rows(duplicates.with_group_count(df, ["k"]), "v", "n") == [(1, 2), (2, 2), (3, 2), (4, 2), (5, 1)]


def test_resolve_conflicts(frame):
    df = frame(
        [
            ("blank only", ""), ("blank and one", ""), ("blank and one", "D"), ("two", "D"), ("two", "P"),
            ("same", "D"), ("same", "D"), ("missing only", None), ("missing and one", None), ("missing and one", "D"),
            ("blank and missing", ""), ("blank and missing", None),
        ],
        "k string, e string",
    )
    assert dict(rows(duplicates.resolve_conflicts(df, ["k"], "e"))) == {
        "blank only": "", "blank and one": "D", "two": "Unknown", "same": "D", "missing only": None,
        "missing and one": "Unknown", "blank and missing": None,
    }


# --- totals, rows, calendar, extract ---------------------------------------------------


def test_totals_and_control(frame):
    df = frame([("a", 1, 2.0), ("a", 2, 3.0), (None, 3, 4.0)], "k string, i int, m double")
    assert rows(aggregates.sum_by(df, ["k"], ["m"])) == [("a", 5.0), (None, 4.0)]
    assert rows(aggregates.reconcile(df, ["k"])) == [(3, 2)]
    assert rows(aggregates.reconcile(df.filter("false"), ["k"])) == [(0, 0)]


def test_varchar_widths(frame):
    df = frame([("abc", None, "", 1), ("é", None, "", 2)], "a string, b string, c string, n int")
    assert rows(aggregates.varchar_widths(df)) == [("a", 3), ("b", 1), ("c", 1)]


def test_literal_rows(frame):
    countries = frame([("F",), ("F",), ("G",)], "country string")
    out = row_ops.literal_rows(countries, ["A", "B"], [{"x": "1", "y": "2"}, {"x": "3", "y": "4"}])
    assert out.count() == 8
    assert set(rows(out.filter("country = 'G' and brand = 'B'"))) == {("1", "2", "G", "B"), ("3", "4", "G", "B")}


def test_flag_missing(frame):
    ops = frame([("a", "F"), ("a", "F"), ("b", "F")], "op string, country string")
    out = row_ops.flag_missing(ops, frame([("b", "F")], "op string, country string"), ["op", "country"], {"flag": F.lit("!")})
    assert rows(out) == [("a", "F", "!")]


def test_complete(frame):
    kind = "op string, country string, category string"
    ref = frame([("a", "F", "1"), ("a", "F", "2"), ("a", "F", "1"), (None, "F", "3")], kind)
    ops = frame([("a", "F", "!"), ("b", "F", "!"), ("b", "F", "!"), ("b", "F", "?"), (None, "F", "!"), ("a", "G", None)], kind)
    assert rows(row_ops.complete(ref, ops, ["op", "country"])) == [
        ("a", "F", "1"), ("a", "F", "2"), ("a", "G", None), ("b", "F", "!"), ("b", "F", "?"), (None, "F", "!"), (None, "F", "3"),
    ]
    assert rows(row_ops.complete(ref.limit(0), ops, ["op", "country"])) == rows(ops.distinct())
    assert rows(row_ops.complete(ref, ops.limit(0), ["op", "country"])) == rows(ref.distinct())


def test_calendar(spark):
    out = {r["date"]: r for r in calendar(spark, date(2019, 12, 31), date(2020, 3, 1)).collect()}
    assert len(out) == 62 and date(2020, 2, 29) in out
    assert tuple(out[date(2020, 2, 5)]) == (
        date(2020, 2, 5), "05", 2, 2020, "2/20", "Feb", "February", "Feb-2020", "February 2020", "Q1", "2020 Q1",
        20200205, 202002,
    )


def test_calendar_of(frame):
    df = frame([(date(2020, 1, 1),), (None,), (date(2020, 1, 5),)], "d date")
    assert calendar_of(df, "d").count() == 5
    assert calendar_of(df.filter("d is null"), "d").count() == 0


def test_extract_chain(frame):
    base = frame([(1, date(2021, 5, 9), "B"), (2, date(2021, 5, 7), "B"), (3, date(2021, 5, 10), "-")], "vin int, d date, version string")
    parts = frame([(1, "p1", 10)], "vin int, part string, code int")
    codes = frame([(10, "c10")], "code int, name string")
    out = extract(
        base, [(parts, "vin"), (codes, "code")], ["vin", "part", "name"], {"version": ["-"]}, True, "d", date(2021, 5, 11), 3
    )
    assert rows(out) == [(1, "p1", "c10")]
    kept = extract(base, [(parts, "vin"), (codes, "code")], ["vin", "name"], {"version": ["-"]})
    assert rows(kept) == [(3, None)]
    assert extract(base).columns == base.columns


def test_extract_joins_only_for_columns(frame):
    base = frame([(1, "x")], "vin int, label string")
    twice = frame([(1, "a"), (1, "b")], "vin int, part string")
    assert rows(extract(base, [(twice, "vin")])) == [(1, "x")]
    with pytest.raises(ValueError, match="label"):
        extract(base, [(base, "vin")], ["vin", "label"])


def test_totals_are_exact(frame):
    """Decimals are summed without rounding; doubles are summed as they are."""
    small = frame([("0.000040",)] * 3 + [("1.123456",)] * 2, "t string").select(F.col("t").cast("decimal(28,6)").alias("m"))
    assert small.agg(aggregates.totals(small, ["m"])["m"].alias("m")).first().m == 2.247032
    large = frame([(1e15,), (1.0,)], "m double")
    assert large.agg(aggregates.totals(large, ["m"])["m"].alias("m")).first().m == 1e15 + 1
    odd = frame([(float("nan"),), (1.0,)], "m double")
    assert odd.agg(aggregates.totals(odd, ["m"])["m"].alias("m")).first().m != 0
    assert str(odd.agg(aggregates.totals(odd, ["m"])["m"].alias("m")).first().m) == "nan"


def test_windows():
    assert list(month_windows(date(2019, 11, 5), 3)) == [
        (date(2019, 11, 1), date(2019, 11, 30)), (date(2019, 12, 1), date(2019, 12, 31)), (date(2020, 1, 1), date(2020, 1, 31)),
    ]
    assert last_days(date(2020, 1, 31)) == (date(2020, 1, 1), date(2020, 1, 31))


def test_reduce_fact(frame):
    df = frame([(date(2020, 2, 3),), (date(2021, 1, 1),)], "d date")
    assert rows(reduce_fact(df, "d", date(2020, 1, 1), date(2020, 12, 31))) == [(date(2020, 2, 3), 2020, 2, 3)]


def test_ordered_categories(frame):
    df = frame([("b",), ("a",), ("z",)], "category string")
    ref = frame([("a", 2), ("b", 1)], "category string, position int")
    assert [tuple(r) for r in ordered_categories(df, ref).collect()] == [("b", 1), ("a", 2), ("z", None)]
