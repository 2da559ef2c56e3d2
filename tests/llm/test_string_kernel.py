from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from forecourt.llm import string_kernel
from forecourt.llm.common import bucket, prepared
from tests.llm.cases import documents, nasty


def brute(text):
    data = text.lower().encode("utf-8", "replace")
    data = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in data)
    return {data[k : k + n] for n in (1, 2, 3) for k in range(len(data) - n + 1)}


def test_presence_is_the_set_of_ngrams(monkeypatch):
    for text in ("", "a", "ab", "abcabc", "Ünï 文字 123", "banana " * 100):
        assert len(string_kernel.presence(text)) == len(brute(text))
    whole = np.sort(string_kernel.presence("the quick brown fox " * 50 + "end"))
    monkeypatch.setattr(string_kernel, "PART", 64)
    assert np.sort(string_kernel.presence("the quick brown fox " * 50 + "end")).tolist() == whole.tolist()


def test_folded_product_is_the_kernel_machine():
    """The batch product gives what kernel values with all landmarks and the regression give."""
    texts = ["the cat sat", "the dog ran", "le chat noir", "le chien court", "the end", "la fin"]
    labels = ["en", "en", "fr", "fr", "en", "fr"]
    model = string_kernel.fit(texts, labels, landmarks=4)
    marks = [0, 2, 1, 3]  # language by language in turn
    sets = [brute(t) for t in texts]
    kernel = np.array([[len(s & sets[m]) / np.sqrt(len(s) * len(sets[m])) for m in marks] for s in sets])
    values, vectors = np.linalg.eigh(kernel[marks])
    root = vectors / np.sqrt(values)
    features = kernel @ root
    around = features - features.mean(0)
    targets = np.array([[1, -1] if label == "en" else [-1, 1] for label in labels], float)
    beta = np.linalg.solve(around.T @ around + 0.05 * np.eye(4), around.T @ (targets - targets.mean(0)))
    expected = around @ beta + targets.mean(0)
    names, scores = string_kernel.predict(model, model.lookup(), texts)
    assert names == [["en", "fr"][k] for k in expected.argmax(1)]
    assert np.allclose(scores, np.clip((expected.max(1) + 1) / 2, 0, 1), atol=1e-5)


def test_held_out_accuracy(spark):
    prepared(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = bucket("doc_id", 5) == 0
    model = string_kernel.learn(docs.filter(~held), "text", "lang", "doc_id", per_label=60, landmarks=40)
    rows = string_kernel.identify(docs.filter(held), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_sample_is_bounded(spark):
    df = spark.range(5000).select(F.col("id").alias("key"), F.lit("t").alias("text"), F.when(F.col("id") % 50 == 0, "rare").otherwise("hot").alias("label"))
    sample = string_kernel.training_sample(df, "text", "label", "key", 60).collect()
    counts = {name: sum(r.label == name for r in sample) for name in ("hot", "rare")}
    assert 30 < counts["hot"] < 130 and 40 < counts["rare"] <= 100


def test_odd_rows(spark):
    df = nasty(spark)
    train = documents(spark, ["the cat sat on the mat", "the dog"]).withColumn("lang", F.lit("en"))
    more = documents(spark, ["der Hund und die Katze", None, ""]).withColumn("lang", F.lit("de"))
    model = string_kernel.learn(train.union(more), "text", "lang", "doc_id")
    rows = string_kernel.identify(df, model).collect()
    assert len(rows) == df.count() and {r.lang_pred for r in rows} == {"de", "en", "und"}
    assert len([r for r in rows if (r.lang_pred, r.score) == ("und", 0.0)]) == 5  # two nulls, no letter in three
    assert all(r.hash == 7 for r in rows)
    nothing = string_kernel.learn(train.limit(0), "text", "lang", "doc_id")
    assert nothing is None and {r.lang_pred for r in string_kernel.identify(df, nothing).collect()} == {"und"}
    assert string_kernel.identify(df.limit(0), model).collect() == []
