from __future__ import annotations

from itertools import product

import pytest
from pyspark.sql import functions as F

from forecourt.llm.hilbert_shards import hilbert_shards, text_bounds, with_curve_index, write_shards
from tests.llm.cases import nasty


@pytest.mark.parametrize(("axes", "bits"), [(2, 3), (3, 2)])
def test_curve_visits_neighbours(spark, axes, bits):
    """The index is a bijection, and cells that follow each other differ by one step on one axis."""
    names = [f"x{k}" for k in range(axes)]
    cells = spark.createDataFrame(list(product(range(1 << bits), repeat=axes)), names)
    found = {r.h: tuple(r[n] for n in names) for r in with_curve_index(cells, names, bits, "h").collect()}
    assert sorted(found) == list(range(1 << (axes * bits)))
    for k in range(len(found) - 1):
        assert sum(abs(a - b) for a, b in zip(found[k], found[k + 1], strict=True)) == 1


def check(rows, shards, n):
    sizes = [sum(r.shard == k for r in rows) for k in range(shards)]
    assert sum(sizes) == len(rows) == n and max(sizes) - min(sizes) <= 1
    for k in range(shards):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sizes[k]))
    order = [r.hilbert for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


def test_shards_are_equal_runs(spark):
    df = spark.range(1000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 7).cast("string").alias("lang"), F.when(F.col("id") % 3 > 0, F.col("id") * 31 % 101).alias("size")
    )
    rows = hilbert_shards(df, ["lang", "size"], ["doc_id"], 8).collect()
    check(rows, 8, 1000)
    again = hilbert_shards(df.repartition(5), ["lang", "size"], ["doc_id"], 8).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_odd_rows(spark):
    df = nasty(spark)
    rows = hilbert_shards(df.drop("shard"), ["lang", "source", "n_chars"], ["doc_id", "text"], 8).collect()
    check(rows, 8, df.count())
    assert rows[0].hash == 7
    few = hilbert_shards(df.limit(3), ["lang"], ["doc_id"], 8).collect()
    check(few, 8, 3)
    assert hilbert_shards(df.limit(0), ["lang", "n_chars"], ["doc_id"], 8).collect() == []


def test_text_bounds_are_quantiles_of_whole_values(spark):
    """Values that share long beginnings, one with a third of the rows, nulls and none at all."""
    texts = [f"https://example.org/archive/{k * 37 % 101:03d}" for k in range(200)] + ["https://example.org/hot"] * 100 + ["é", ""]
    df = spark.createDataFrame([(t,) for t in texts + [None] * 9], "value string").repartition(7)
    texts.sort(key=lambda t: t.encode())
    assert text_bounds(df, "value", 16) == [texts[-(-len(texts) * k // 16) - 1] for k in range(1, 16)]
    assert text_bounds(df.filter("value is null"), "value", 16) == []


def test_values_that_share_their_first_bytes_are_told_apart(spark):
    df = spark.range(400).select(
        F.col("id").alias("doc_id"), F.format_string("common_crawl_release_of_%03d", F.col("id") * 7 % 40).alias("source")
    )
    rows = hilbert_shards(df, ["source"], ["doc_id"], 8).collect()
    check(rows, 8, 400)
    assert max(len({r.source for r in rows if r.shard == k}) for k in range(8)) <= 8


def test_files_cover_narrow_ranges(spark, tmp_path):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") * 7919 % 2000).alias("x"), (F.col("id") * 104729 % 2000).alias("y"))
    write_shards(hilbert_shards(df, ["x", "y"], ["doc_id"], 16), str(tmp_path / "out"))
    boxes = spark.read.parquet(str(tmp_path / "out")).groupBy("shard").agg(F.max("x") - F.min("x"), F.max("y") - F.min("y")).collect()
    assert len(boxes) == 16 and sum(r[1] for r in boxes) / 16 < 1000 and sum(r[2] for r in boxes) / 16 < 1000
