from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.llm import collocations
from forecourt.llm.collocations import collocations as find
from tests.llm.cases import documents, nasty


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, most_words: int, least: int, top: int | None) -> list[tuple]:
    f: dict[str, Counter] = defaultdict(Counter)
    n: Counter = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, most_words + 1):
                f[lang].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        good = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in good.items():
            longer = (q for q, c in good.items() if len(q) > len(p) and 100 * c >= 100 * a)
            if any(q[k : k + len(p)] == p for q in longer for k in range(len(q) - len(p) + 1)):
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def held(df, **options) -> int:
    expected = brute([(r.lang, r.text) for r in df.collect()], **options)
    assert sorted(tuple(r) for r in find(df, **options).collect()) == expected
    return len(expected)


def draw(seed: int, n: int, words: list[str], stops: str) -> list[str]:
    pick = random.Random(seed)
    return ["".join(pick.choice(words) + pick.choice(stops) for _ in range(pick.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("options", [{"most_words": 5, "least": 3, "top": 40}, {"most_words": 5, "least": 2, "top": None}, {"most_words": 2, "least": 4, "top": 3}])
def test_brute_force(spark, options):
    few = draw(1, 60, ["a", "A", "b", "é", "É", "c-d"], "   \t ,.\n;")
    many = draw(2, 60, [f"w{k}" for k in range(12)], "     .")
    df = documents(spark, few + many + ["the red car of the town"] * 9 + ["the  red\tcar of"] * 3)
    df = df.withColumn("lang", F.when(F.col("doc_id") % 5 == 0, F.lit(None)).when(F.col("doc_id") % 5 < 3, "en").otherwise("und"))
    assert held(df, **options) > 3


def test_ties_at_the_end_of_the_list_go_by_spelling(spark):
    df = documents(spark, [" . ".join([f"x{k} y{k}" for k in range(30)])] * 4)
    assert held(df, most_words=3, least=2, top=7) == 7


def test_overlaps_and_covered_phrases(spark):
    df = documents(spark, ["a a a a a a"] * 3 + ["new york city"] * 5 + ["york city hall"] * 2 + ["x y. x y; x y!"])
    assert held(df, most_words=5, least=3, top=100)


def test_odd_rows(spark):
    df = nasty(spark)
    assert held(df, most_words=5, least=5, top=50) >= 1
    assert find(df.limit(0)).collect() == []
    assert find(df.filter("text is null")).collect() == []
    assert find(df, least=10**9).collect() == []
    assert find(documents(spark, ["one two three"]).drop("source")).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_small_gatherings_and_tables_change_nothing(spark, monkeypatch):
    # a table of few bits lets rare phrases through; they are counted and dropped
    rows = [(draw(k, 1, ["a", "b", "c", "d"], "  ,")[0], "en") for k in range(50)]
    known = collocations.Known(3, np.full(1, 255, np.uint8))
    texts, langs = [t.encode() for t, _ in rows], [x for _, x in rows]
    free = collocations._found(texts, langs, 3, None)
    through = collocations._found(texts, langs, 3, known)
    assert all(np.array_equal(x, y) for x, y in zip(free, through, strict=True))
    twice = collocations._added([(*free[:3], np.zeros(len(free[0]), np.int64), free[3])] * 2)
    assert np.array_equal(twice[4], 2 * free[3]) and np.array_equal(twice[0], free[0])


def test_numbers_in_the_table_are_found(spark):
    numbers = np.random.default_rng(1).integers(-(2**63), 2**63, 5000)
    df = spark.createDataFrame([(int(x),) for x in numbers], "id long")
    known = collocations.Known(*collocations.bit_table(df))
    assert known.has(numbers.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(0, 2**63, 100_000).astype(np.uint64)
    assert known.has(others).mean() < 0.001


def test_products_beyond_64_bits_are_exact(spark):
    a, n, left, right = 10**11 + 7, 10**13 + 9, 3 * 10**11 + 1, 2 * 10**11 + 3
    phrases = spark.createDataFrame([("en", 1, a, [left, right], [right, left], None)], "lang string, id long, a long, lefts array<long>, rights array<long>, most long")
    totals = spark.createDataFrame([("en", n)], "lang string, total long")
    r = collocations.scored(phrases, totals).first()
    assert r.score == 1000 * a * n // (left * right) and (r.l, r.r) == (left, right)


def test_streams_are_merge_joined(spark):
    df = documents(spark, ["a b c d"] * 5)
    found, _ = collocations.streams(df.select("lang", "text"), 3, 2)
    plan = found[1].join(found[0].select(F.col("id").alias("first"), "n").hint("merge"), "first")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and len(found) == 3
