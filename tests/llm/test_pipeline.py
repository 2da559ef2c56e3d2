from __future__ import annotations

import hashlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import compare
from forecourt.llm import queries
from forecourt.llm.common import table
from tests.llm.cases import nasty

FOLDER = "/root/testdata/sf0.001"


def test_everything_is_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    good, note = compare(spark, FOLDER, name)
    assert good, note


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_queries_cover_the_table(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    ids = {r.doc_id for r in df.select("doc_id").collect()}
    all_ids = {r.doc_id for r in table(spark, FOLDER, "documents").select("doc_id").collect()}
    partial = name.startswith(("op4_", "op5_", "op8_"))  # one row per finding
    assert ids <= all_ids if partial else ids == all_ids


def test_stages_keep_columns_and_order(spark):
    docs = table(spark, FOLDER, "documents")
    run = corpus_pipeline.run(spark, FOLDER)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert docs.count() <= before
    rows = {r.doc_id: r for r in run.collect()}
    for r in docs.collect():
        assert rows[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
    assert len(rows) == docs.count() > 100


@pytest.mark.parametrize("number", range(5))
def test_stages_survive_odd_rows(spark, number):
    df = nasty(spark)
    stage = corpus_pipeline.STAGES[number][1]
    out = stage(spark, df, FOLDER)
    lost = {"near duplicates": 1}.get(corpus_pipeline.STAGES[number][0], 0)
    assert out.count() == df.count() - lost
    assert stage(spark, df.limit(0), FOLDER).count() == 0
    if number < 4:
        assert out.columns == df.columns
