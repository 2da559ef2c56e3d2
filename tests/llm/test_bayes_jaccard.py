from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from forecourt.llm import bayes_jaccard
from forecourt.llm.components import components
from tests.llm.cases import documents, nasty, prose


def brute(texts, threshold=0.8):
    """Class id, number of linked texts and number of copies of each document."""
    sets = {}
    for t in set(texts) - {None}:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets[t] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    own = {t: {t} for t in sets}
    linked = {t: 0 for t in sets}
    different = list(sets)
    for k, a in enumerate(different):
        for b in different[k + 1 :]:
            if sets[a] & sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                linked[a] += 1
                linked[b] += 1
                both = own[a] | own[b]
                own |= dict.fromkeys(both, both)
    return [
        (k, 0, 1) if t is None else (min(j for j, u in enumerate(texts) if u in own[t]), linked[t], texts.count(t))
        for k, t in enumerate(texts)
    ]


def edited(text, edits, seed):
    draw, out = random.Random(seed), text.split()
    for _ in range(edits):
        out[draw.randrange(len(out))] = f"new{draw.randrange(10**6)}"
    return " ".join(out)


def corpus():
    texts = []
    for k in range(12):
        base = prose(k, 80 + 10 * k)
        texts += [base, base, *[edited(base, e, 100 * k + e) for e in range(1, 9)]]
    return [*texts, *[prose(500 + k, 50) for k in range(30)], None, None, "", "", " ", "a b", "a b", "a  b", "b a"]


@pytest.mark.parametrize("blocks", [None, 3])
def test_same_as_brute_force(spark, monkeypatch, blocks):
    """Also when buckets and clusters are cut into very small blocks."""
    if blocks:
        monkeypatch.setattr(bayes_jaccard, "BUCKET_BLOCK", blocks)
        monkeypatch.setattr(bayes_jaccard, "CLUSTER_BLOCK", blocks)
    texts = corpus()
    rows = {r.doc_id: r for r in bayes_jaccard.near_duplicates(documents(spark, texts)).collect()}
    assert [(rows[k].class_id, rows[k].n_links, rows[k].n_copies) for k in range(len(texts))] == brute(texts)


def test_large_group(spark):
    """A group of hundreds of near copies of each other; rows stay linear in its size."""
    base = prose(7, 400)
    texts = [edited(base, 4, k) for k in range(300)]
    rows = bayes_jaccard.near_duplicates(documents(spark, texts)).collect()
    expected = brute(texts)
    assert {(r.doc_id, r.class_id, r.n_links) for r in rows} == {(k, c, n) for k, (c, n, _) in enumerate(expected)}


def test_one_document_of_each_class_stays(spark):
    texts = corpus()
    df = documents(spark, [*texts, texts[0]], [*range(len(texts)), 0])
    out = bayes_jaccard.one_per_class(df)
    assert out.columns == df.columns
    expected = sorted({c for c, _, _ in brute(texts)})
    assert sorted(r.doc_id for r in out.collect()) == expected


def test_pruning_follows_the_posterior():
    needed = bayes_jaccard.least_agreement(0.8, 1e-6)
    assert needed == sorted(needed) and needed[0] < 16 * 0.5 and needed[-1] < 64 * 0.8
    strict = bayes_jaccard.least_agreement(0.8, 0.5)
    assert strict[-1] >= 64 * 0.75 and all(s >= n for s, n in zip(strict, needed, strict=True))


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 60)], [(5, 3), (3, 5), (9, 8), (8, 3), (20, 21)]])
def test_components(spark, edges):
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = components(spark.createDataFrame(edges, "a int, b int"))
    assert {(r.node, r.root) for r in found.collect()} == {(n, r) for n, r in root.items() if edges != [(1, 1)]}


def test_odd_rows(spark):
    df = nasty(spark)
    rows = bayes_jaccard.near_duplicates(df).collect()
    assert len(rows) == df.count() and {r.n_links for r in rows} == {0}
    assert sorted(r.n_copies for r in rows if r.doc_id == 60) == [2, 2]
    out = bayes_jaccard.one_per_class(df)
    assert out.filter("doc_id = 60").count() == 1 and out.filter("text is null").count() == 2
    assert out.count() == df.count() - 1
    assert bayes_jaccard.near_duplicates(df.limit(0)).collect() == [] and bayes_jaccard.one_per_class(df.limit(0)).collect() == []
    assert bayes_jaccard.near_duplicates(df.filter(F.col("text").isNull())).count() == 2
