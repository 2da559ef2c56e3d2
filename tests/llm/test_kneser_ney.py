from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from forecourt.llm import kneser_ney
from tests.llm.cases import documents, nasty, prose


def words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "the end"]


class Plain:
    """The same model with dictionaries."""

    def __init__(self, texts, order):
        lines = [words(t) for t in texts]
        self.order = order
        self.one = Counter(w for line in lines for w in line)
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.counts = {order: Counter(g for line in lines for g in self.grams(line))}
        for size in range(order - 1, 0, -1):
            self.counts[size] = Counter(g[1:] for g in self.counts[size + 1])
        self.cuts, self.total, self.rest = {}, {}, {}
        for size, counts in self.counts.items():
            sizes = Counter(counts.values())
            self.cuts[size] = [0.0, *kneser_ney.discounts([sizes[k] for k in (1, 2, 3, 4)])]
            self.total[size], self.rest[size] = Counter(), defaultdict(float)
            for g, c in counts.items():
                self.total[size][g[:-1]] += c
                self.rest[size][g[:-1]] += self.cuts[size][min(c, 3)]

    def grams(self, line):
        padded = ["the begin"] * (self.order - 1) + line
        return [tuple(padded[k : k + self.order]) for k in range(len(line))]

    def chance(self, gram):
        size = len(gram)
        lower = self.chance(gram[1:]) if size > 1 else 1 / (self.v + 1)
        total = self.total[size][gram[:-1]]
        if not total:
            return lower
        c = self.counts[size][gram]
        return max(c - self.cuts[size][min(c, 3)], 0) / total + self.rest[size][gram[:-1]] / total * lower

    def score(self, text):
        line = words(text)
        return (
            len(line),
            sum(self.one[w] > 0 for w in line),
            self.n,
            sum(math.log10((self.one[w] + 1) / (self.n + self.v + 1)) for w in line),
            sum(math.log10(self.chance(g)) for g in self.grams(line)),
        )


def compare(spark, train, other, parts, order):
    model = kneser_ney.train(documents(spark, train), parts=parts, order=order)
    plain = Plain(train, order)
    rows = kneser_ney.score(documents(spark, other), model).collect()
    for r in rows:
        expected = plain.score(other[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == expected[:3]
        assert r.base_score == pytest.approx(expected[3]) and r.score == pytest.approx(expected[4], abs=1e-9)
        assert r.perplexity == pytest.approx(10 ** (-expected[4] / expected[0]))
    return plain


@pytest.mark.parametrize("order", [2, 3, 4])
def test_same_as_dictionaries(spark, order):
    train = ["a b a b c", "A b c d e f a", "a b", "", None, "d d d d", *[prose(k % 3, 30) for k in range(8)], *[prose(k, 400) for k in range(20, 24)]]
    plain = compare(spark, train, [*train, "a x b", "never seen", " ", "a b a c d d"], 5, order)
    for context in (["the begin"] * 3, ["a", "b", "a"], ["d"] * 3, ["x", "y", "b"]):
        before = tuple(context[4 - order :])
        assert sum(plain.chance((*before, w)) for w in [*plain.one, "not a word"]) == pytest.approx(1.0)


def test_parts_follow_the_texts(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "PART_BYTES", 100)
    df = documents(spark, [prose(k, 100) for k in range(20)])
    assert kneser_ney.train(df).parts >= 20 * 100 * 3 // 100
    with pytest.raises(ValueError, match="order"):
        kneser_ney.train(df, order=1)


def test_without_training_texts(spark):
    compare(spark, [], ["a b", "", None], 3, 3)


def test_odd_rows(spark):
    df = nasty(spark)
    scored = kneser_ney.score(df, kneser_ney.train(df, parts=2))
    rows = scored.collect()
    assert len(rows) == df.count() and all(math.isfinite(r.score) and r.score <= 0 and r.hash == 7 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id == 0} == {1}


def test_folder_must_be_mounted(spark):
    with pytest.raises(ValueError, match="mounted"):
        kneser_ney.train(documents(spark, ["a"]), folder="hdfs://host/x")


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_equal_ngrams_are_added_up_where_their_short_numbers_agree(width):
    draw = np.random.default_rng(width)
    numbers = np.array([1, 2, 1 + (1 << 21), 1 + (1 << 16), 1 + (1 << 22), kneser_ney.START], np.uint32)
    grams = numbers[draw.integers(0, len(numbers), (3000, width))]
    found, counts = kneser_ney._merged(grams)
    assert dict(zip(map(tuple, found.tolist()), counts[:, 0].tolist(), strict=True)) == Counter(map(tuple, grams.tolist()))
    assert len(found) == len(np.unique(grams, axis=0))
    again, sums = kneser_ney._merged(grams, np.arange(len(grams))[:, None])
    assert again.tolist() == found.tolist() and sums.sum() == np.arange(len(grams)).sum()


def test_parcels_are_no_wider_than_their_numbers():
    for rows in (np.array([[3, 0], [1, 255], [2, 7]]), np.array([[1 << 40, 2]]), np.array([[kneser_ney.START], [1]], np.uint32)):
        data = kneser_ney._packed(rows)
        assert kneser_ney._unpacked(data, np.int64, rows.shape[1]).tolist() == rows.tolist()
    counts = np.random.default_rng(0).integers(0, 1 << 8, (1 << 16, 1))
    plain = kneser_ney._packed(counts + (1 << 32))
    assert len(kneser_ney._packed(counts)) < min(len(plain), (1 << 16) + 100)
