from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from forecourt.llm import ordinal_toxicity as toxicity
from tests.llm.cases import documents, nasty, prose

BAD = ["nastyword", "uglything", "hatefully"]


def labelled(spark, n=300):
    draw = random.Random(3)
    texts, labels = [], []
    for k in range(n):
        own = prose(k, 40).split()
        level = draw.choice([0, 0, 0, 1, 2])
        for _ in range(2 * level):
            own.insert(draw.randrange(len(own)), draw.choice(BAD) + draw.choice(["", "s", "er"]))
        texts.append(" ".join(own))
        labels.append((k, level))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, grade int")


def test_thresholds_are_ordered_and_weights_shared():
    draw = np.random.default_rng(1)
    columns = draw.integers(0, 3, 400)
    rows = np.arange(400)
    grades = np.clip(columns + (draw.random(400) < 0.1), 0, 2)
    weights, cuts = toxicity.fit_ordinal(rows, columns, grades, 3)
    assert cuts[0] < cuts[1] and weights[0] < weights[1] < weights[2]


def test_gradient_finds_the_maximum():
    """No small step in any direction makes the grades likelier."""
    draw = np.random.default_rng(2)
    rows, columns = np.repeat(np.arange(200), 2), draw.integers(0, 4, 400)
    grades = draw.integers(0, 3, 200)
    weights, cuts = toxicity.fit_ordinal(rows, columns, grades, 4, ridge=0.1)

    def loss(w, c):
        total = np.bincount(rows, w[columns], 200)
        edges = np.concatenate(([-np.inf], c, [np.inf]))
        chance = toxicity.sigmoid(edges[grades + 1] - total) - toxicity.sigmoid(edges[grades] - total)
        return -np.log(chance).sum() + 0.05 * (w**2).sum()

    best = loss(weights, cuts)
    for k in range(4):
        for step in (-0.05, 0.05):
            moved = weights.copy()
            moved[k] += step
            assert loss(moved, cuts) > best - 1e-3
    for step in (-0.05, 0.05):
        assert loss(weights, cuts + np.array([step, 0])) > best - 1e-3


def test_rare_words_tell_in_large_samples(spark):
    """A word of 15 toxic rows and no clean one counts among 20,000 rows as among 5,000."""
    rows = [("calm words " + ("rareword" if k < 15 else "often"), int(k < 2000)) for k in range(20_000)]
    sample = spark.createDataFrame(rows, "text string, label int")
    chosen = {r.code for r in toxicity.telling_features(sample, 1000, 20.0).filter("leans").collect()}
    own = toxicity.features([b"rareword"])[1]
    assert set(own.astype("uint64").view("int64").tolist()) & chosen


def test_held_out_grades(spark):
    docs, labels = labelled(spark)
    seen = labels.filter("doc_id < 200")
    model = toxicity.learn_from_tables(docs, seen, "grade")
    rows = toxicity.grade(docs, model).join(labels, "doc_id").filter("doc_id >= 200").collect()
    assert all((r.p_toxic > toxicity.REJECT) == (r.grade > 0) for r in rows)
    assert np.corrcoef([r.severity for r in rows], [r.grade for r in rows])[0, 1] > 0.8
    assert all(0 <= r.severity <= 2 and r.hash == 7 for r in rows)
    kept = {r.doc_id for r in toxicity.accepted(docs, model).collect()}
    assert {r.doc_id for r in rows if r.grade == 0} <= kept and not {r.doc_id for r in rows if r.grade > 0} & kept


def test_two_labels_become_grades(spark):
    docs, labels = labelled(spark)
    model = toxicity.learn_from_tables(docs, labels.withColumn("grade", (F.col("grade") > 0).cast("int")), "grade")
    rows = toxicity.grade(docs, model).join(labels, "doc_id").collect()
    level = {g: np.mean([r.severity for r in rows if r.grade == g]) for g in (0, 1, 2)}
    assert level[0] < 0.2 < level[1] < level[2]


def test_copies_count_once(spark):
    texts = [prose(1, 50)] * 5 + [prose(1, 50) + " changed end"] + [prose(2, 50), "two words", "two words", ""]
    kept = toxicity.without_copies(documents(spark, texts))
    assert {r.doc_id for r in kept.collect()} == {0, 6, 7, 8, 9}


def test_texts_that_share_a_passage_are_no_copies(spark):
    """Two of five words shared: no copy, and no row of the sample is lost. One word of a hundred changed: a copy."""
    shared = prose(100, 40)
    texts = [f"{shared} {prose(k, 60)}" for k in range(12)]
    edited = texts[3].split()
    edited[50] = "otherword"
    kept = toxicity.without_copies(documents(spark, [*texts, " ".join(edited)]))
    assert {r.doc_id for r in kept.collect()} == set(range(12))


def test_odd_rows(spark):
    df = nasty(spark)
    docs, labels = labelled(spark, 100)
    model = toxicity.learn_from_tables(docs, labels.union(labels).union(spark.createDataFrame([(None, 1), (1, None)], "doc_id long, grade int")), "grade")
    rows = toxicity.grade(df, model).collect()
    assert len(rows) == df.count() and all(r.p_toxic < toxicity.REJECT for r in rows)
    assert toxicity.accepted(df, model).count() == df.count()
    for nothing in (labels.limit(0), labels.filter("grade = 0")):
        assert toxicity.learn_from_tables(docs, nothing, "grade") is None
    assert {r.severity for r in toxicity.grade(df, None).collect()} == {0.0}
    assert toxicity.accepted(df, None).count() == df.count() and toxicity.grade(df.limit(0), model).collect() == []


def test_frequent_labels_alone_reject_nothing(frame):
    """Texts without a telling feature stay, also where the thresholds alone say more than the bound."""
    model = toxicity.Model(np.array([7], np.uint64), np.array([9.0]), np.array([1.0, 2.0]))
    df = frame([(1, "plain words"), (2, None), (3, "")], "doc_id long, text string")
    assert all(r.p_toxic > toxicity.REJECT for r in toxicity.grade(df, model).collect())
    assert toxicity.accepted(df, model).count() == 3
    assert toxicity.bound(None) == toxicity.REJECT
