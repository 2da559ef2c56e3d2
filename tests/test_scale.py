"""Plans and hot keys: what must hold when the data is large."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from forecourt.operators import duplicates, joins
from forecourt.operators.joins import DimSpec, attach
from forecourt.plans import registrations, sales
from forecourt.session import tune
from tests.conftest import rows
from workload import marts
from workload.registry import Tables

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith("q_")))
def test_plan_is_distributed(spark, settings, name):
    settings(autoBroadcastJoinThreshold=-1)
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "Window "):
        assert unwanted not in plan
    # The report order and the counts over a whole table end in one small partition.
    if name not in ("q_calendar", "q_reconcile", "q_varchar_widths"):
        assert "SinglePartition" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(entry.queries()["q_date_window"](spark, FOLDER))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "l_extendedprice" not in scan


def test_first_row_is_reduced_before_the_shuffle(frame):
    plan = plan_of(duplicates.keep_first(frame([(1, 2)], "k int, v int"), ["k"]))
    before_shuffle = plan[plan.index("Exchange"):]
    assert "partial_min" in before_shuffle


def test_hot_fact_key_is_split(spark, settings):
    tune(spark)
    settings(
        autoBroadcastJoinThreshold=-1,
        adaptive__autoBroadcastJoinThreshold=-1,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        shuffle__partitions=16,
    )
    ids = spark.range(60_000, numPartitions=8)
    fact = ids.select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    dim = spark.range(-1, 60_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("name"))
    joined = attach(fact, [DimSpec(dim, ["k"], "left")])
    collected = joined.groupBy("k").agg(F.count("*").alias("n"), F.max("name").alias("name"))
    assert {r.n for r in collected.filter("k = -1").collect()} == {20_000}
    joined.write.format("noop").mode("overwrite").save()
    assert len(joined.collect()) == 60_000
    assert "skew=true" in plan_of(joined)


def test_hot_dimension_key(frame):
    """The left join in two parts equals the plain one."""
    fact = frame([("hot", 1), ("hot", 2), ("one", 3), ("none", 4), (None, 5)], "k string, f int")
    dim = frame([("hot", i) for i in range(60)] + [("one", 7), ("other", 8), (None, 9), ("hot", 0)], "k string, d int")
    dealt = attach(fact, [DimSpec(dim, ["k"], "left", many=True)])
    assert rows(dealt) == rows(attach(fact, [DimSpec(dim, ["k"], "left")]))
    assert dealt.count() == 2 * 61 + 3


def scans(df, table):
    """How often a query that ran has read a table; an exchange that is used again isn't read again."""
    return plan_of(df).split("== Initial Plan ==")[0].count(f"/{table}.parquet")


def test_systems_are_read_twice_at_most(spark, settings):
    settings(autoBroadcastJoinThreshold=-1, adaptive__autoBroadcastJoinThreshold=-1)
    merged = entry.queries()["q_full_outer"](spark, FOLDER)
    assert len(merged.collect()) > 1000
    assert (scans(merged, "orders"), scans(merged, "lineitem")) == (2, 2)
    assert "FullOuter" not in plan_of(merged)
    hot = entry.queries()["q_hot_lines"](spark, FOLDER)
    assert hot.collect()
    assert sorted((scans(hot, "orders"), scans(hot, "lineitem"))) == [1, 2]


def test_hot_key_in_both_systems_is_split(spark, settings):
    settings(adaptive__autoBroadcastJoinThreshold=-1, autoBroadcastJoinThreshold=-1, adaptive__advisoryPartitionSizeInBytes="64k")
    settings(adaptive__skewJoin__skewedPartitionThresholdInBytes="64k", adaptive__skewJoin__skewedPartitionFactor=2)
    ids = spark.range(60_000, numPartitions=8)
    a = ids.select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    b = spark.range(-1, 70_000).select(F.when(F.col("id") != 7, F.col("id")).alias("k"), F.lit("y").alias("y"))
    merged = joins.merge_sources(a, b, ["k"])
    found = merged.collect()
    assert "skew=true" in plan_of(merged)
    plain = a.join(b, "k", "outer")
    assert len(found) == plain.count() and rows(merged.groupBy("y").count()) == rows(plain.groupBy("y").count())


def test_left_join_with_many_rows_equals_the_plain_one(frame):
    fact = frame([(k, j, f"{k}{j}") for k in ("a", "b", None, "c") for j in (1, 2, None)] * 3, "k string, j int, f string")
    dim = frame([("a", 1, "x"), ("a", 1, None), ("b", None, "y"), (None, 2, "z"), ("b", 2, "w")], "dk string, dj int, d string")
    specs = [DimSpec(dim, {"dk": "k", "dj": F.col("j") + 0}, "left", many=many) for many in (True, False)]
    assert rows(attach(fact, [specs[0]])) == rows(attach(fact, [specs[1]]))
    assert rows(attach(fact.limit(0), [specs[0]])) == []
    assert rows(attach(fact, [DimSpec(dim.limit(0), {"dk": "k"}, "left", ["d"], many=True)])) == rows(fact.withColumn("d", F.lit(None)))


def test_hot_key_in_both_systems(frame):
    a = frame([("hot", i) for i in range(5)] + [("a", 1), (None, 2)], "k string, x int")
    b = frame([("hot", i) for i in range(20)] + [("b", 1), (None, 2)], "k string, y int")
    dealt = joins.merge_sources(a, b, ["k"], {"z": ("x", "y")})
    plain = a.join(b, "k", "outer").withColumn("z", F.coalesce("x", "y"))
    assert rows(dealt, "k", "z") == rows(plain, "k", "z")
    assert dealt.count() == 104


def test_hot_key_on_both_sides_is_split(spark, settings):
    """Both sides of the join that many=True makes are split where a key is hot."""
    settings(adaptive__autoBroadcastJoinThreshold=-1, autoBroadcastJoinThreshold=-1, adaptive__advisoryPartitionSizeInBytes="64k")
    settings(adaptive__skewJoin__skewedPartitionThresholdInBytes="64k", adaptive__skewJoin__skewedPartitionFactor=2)
    ids = spark.range(60_000, numPartitions=8)
    fact = spark.range(-1, 60_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    dim = ids.select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("name"))
    joined = attach(fact, [DimSpec(dim, ["k"], "left", many=True)])
    joined.write.format("noop").mode("overwrite").save()
    assert joined.count() == 80_000
    assert len(joined.collect()) == 80_000
    assert "skew=true" in plan_of(joined)


def test_hot_group_count(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    counted = duplicates.with_group_count(df, ["k"])
    assert counted.filter("n = 10000").count() == 10_000


def test_the_sales_fact_is_shuffled_once_and_without_labels(spark, settings):
    settings(autoBroadcastJoinThreshold=-1)
    tables = marts.sales_tables(Tables(spark, FOLDER))
    summed = plan_of(sales.summed_by_id(tables, marts.WINDOW, marts.SALES_MODEL))
    assert "_label" not in summed and "label_fr" not in summed
    assert "partial_sum" in summed
    wide = entry.queries()["q_sales_wide"](spark, FOLDER)
    lines = plan_of(wide).splitlines()
    first = max(k for k, line in enumerate(lines) if "partial_sum" in line)  # the sum next to the fact
    assert "_label" not in lines[first] and "_code" not in lines[first] and "vehicle_id" in lines[first]


def test_sums_by_id_count_repeated_dimension_rows(frame):
    fact = frame([(1, 1, "x", 2.0), (1, 2, "x", 3.0), (1, 3, "x", 4.0), (9, 1, "x", 5.0), (1, None, "x", 6.0)], "base_id int, heading_id int, promo string, volume double").withColumn("sale_date", F.lit("2020-01-05").cast("date"))
    kinds = "id int, code string, label_fr string, label_en string, label_es string"
    tables = {
        "facts": fact,
        "base": frame([(1, "LA", "", "", ""), (1, "LA", "", "", ""), (9, "EA", "", "", "")], kinds),
        "heading": frame([(1, "H", "one", "", ""), (2, "H", "one", "", "")], kinds),
    }
    model = sales.SalesModel(
        dimensions=(
            sales.Dimension("base", {"id": "base_id"}, labelled=False, only=("LA",), reported=False),
            sales.Dimension("heading", {"id": "heading_id"}, "left", fallback=False),
        ),
        attributes=("promo",),
        measures=("volume",),
    )
    wide = sales.sales_wide(tables, (date(2020, 1, 1), date(2020, 1, 31)), model)
    assert rows(wide) == [("x", "H", "one", 10.0), ("x", None, None, 20.0)]


def test_promotions_and_costs_meet_in_an_aggregate(spark, settings):
    settings(autoBroadcastJoinThreshold=-1, adaptive__autoBroadcastJoinThreshold=-1)
    promos = entry.queries()["q_promo_reference"](spark, FOLDER)
    assert promos.collect() and "LeftAnti" not in plan_of(promos)
    assert scans(promos, "lineitem") <= 3  # promotions, booked costs, vehicles


def test_satellites_weight_the_sum_instead_of_the_rows(frame):
    lines = frame([("V1", "E1", 10.0), ("V2", "E2", 5.0), (None, "E1", 7.0)], "vehicle string, engine string, co2 double")
    engines = frame([("E1", "a"), ("E1", "b"), ("E1", "b")], "engine string, maker string")
    moves = frame([("V1", "x")] * 3 + [("V1", "y"), (None, "z")], "vehicle string, place string")
    specs = [
        registrations.satellite(engines, "engines", {"engine": "engine"}, ()),
        registrations.satellite(moves, "moves", {"vehicle": "vehicle"}, ["place"]),
    ]
    assert [s.many for s in specs] == [False, True]
    wide = attach(lines, specs)
    assert wide.count() == 4
    times = [F.coalesce(c, F.lit(1)) for c in wide.columns if c.endswith(registrations.TIMES)]
    weighted = wide.groupBy("vehicle", "place").agg(F.sum(F.col("co2") * times[0] * times[1]).alias("co2"))
    plain = lines.join(engines, "engine", "left").join(moves, "vehicle", "left").groupBy("vehicle", "place").agg(F.sum("co2").alias("co2"))
    assert rows(weighted) == rows(plain)


def test_a_hot_vehicle_in_movements_is_split(spark, settings):
    settings(adaptive__autoBroadcastJoinThreshold=-1, autoBroadcastJoinThreshold=-1, adaptive__advisoryPartitionSizeInBytes="64k")
    settings(adaptive__skewJoin__skewedPartitionThresholdInBytes="64k", adaptive__skewJoin__skewedPartitionFactor=2)
    lines = spark.range(-1, 60_000).select(F.col("id").cast("string").alias("vehicle"), F.lit(1.0).alias("co2"))
    ids = spark.range(60_000, numPartitions=8)
    vehicle = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("string")
    movements = ids.select(vehicle.alias("vehicle"), F.sha2(F.col("id").cast("string"), 256).alias("place"))
    wide = attach(lines, [registrations.satellite(movements, "movements", {"vehicle": "vehicle"}, ["place"])])
    assert len(wide.collect()) == 80_000
    assert "skew=true" in plan_of(wide)


def test_a_fact_meets_tables_with_many_rows_in_one_shuffle(spark, settings):
    """Both tables have the key of the fact, which is dealt by it once."""
    settings(autoBroadcastJoinThreshold=-1, adaptive__autoBroadcastJoinThreshold=-1)
    fact = spark.range(50).select((F.col("id") % 9).alias("k"), F.col("id").alias("f"))
    dims = [spark.range(20).select((F.col("id") % 6).alias("k"), F.col("id").alias(c)) for c in ("a", "b")]
    joined = attach(fact, [DimSpec(d, ["k"], "left", many=True, different=True) for d in dims])
    plain = attach(fact, [DimSpec(d, ["k"], "left") for d in dims])
    assert rows(joined) == rows(plain)
    joined.collect()
    final = plan_of(joined).split("== Initial Plan ==")[0].splitlines()
    assert sum("Range (0, 50," in line for line in final) == 1


def test_registration_lines_are_read_and_dealt_once(spark, settings):
    settings(autoBroadcastJoinThreshold=-1, adaptive__autoBroadcastJoinThreshold=-1)
    found = entry.queries()["q_registration"](spark, FOLDER)
    assert found.collect()
    assert scans(found, "lineitem") == 1
    # Orders and parts; family, pack, file, vehicle, order, profession and the sum.
    joins_of_lines = [i for i, (t, *_) in enumerate(registrations.OPTIONAL_TABLES) if t in ("vehicles", "movements")]
    assert joins_of_lines[1] - joins_of_lines[0] == 1
    assert plan_of(found).split("== Initial Plan ==")[0].count("ReusedExchange") >= 2


@pytest.mark.parametrize("name", ["q_sales_wide", "q_sales"])
def test_labels_of_code_lists_are_not_shuffled(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("vehicle_code" in line for line in dealt)
    assert not any(c in line for line in dealt for c in ("zone_label", "heading_label", "operation_label", "company_code"))
