from __future__ import annotations

import itertools
import random

import numpy as np

from forecourt.llm import spaced_seeds
from tests.llm.cases import documents, nasty, prose


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id int, text string")


def found(df, bench):
    return {(r.doc, r.item): r for r in spaced_seeds.overlaps(df, bench).collect()}


def changed(text, share, seed):
    """Every few words another one, evenly spread."""
    draw, out = random.Random(seed), text.split()
    step = int(1 / share)
    for k in range(draw.randrange(step), len(out), step):
        out[k] = "changed"
    return " ".join(out)


def test_substitutions_are_tolerated(spark):
    bench = [prose(k, 40) for k in range(20)]
    texts = [f"{prose(100 + k, 60)} {changed(t, 0.15, k)}! {prose(200 + k, 60)}".upper() for k, t in enumerate(bench)]
    texts += [prose(300 + k, 200) for k in range(20)]
    got = found(documents(spark, texts), items(spark, bench))
    assert set(got) == {(k, k) for k in range(20)}
    for r in got.values():
        assert r.first_word >= 58 and r.end_word <= 102 and r.item_share > 0.6 and r.end_word - r.first_word >= 13


def test_too_different_or_too_short(spark):
    bench = [prose(1, 40), "seven words are too few to tell", "an item of eight words counts as whole"]
    texts = [
        " ".join(w if k % 2 else "x" for k, w in enumerate(prose(1, 40).split())), " ".join(prose(1, 40).split()[:12]) + " " + prose(9, 40),
        f"before {bench[1]} after", f"before {bench[2]} after", " ".join(prose(1, 40).split()[:13]),
    ]
    assert set(found(documents(spark, texts), items(spark, bench))) == {(3, 2), (4, 0)}


def test_one_row_per_overlap(spark):
    bench = prose(1, 30)
    df = documents(spark, [f"{bench} {prose(2, 100)} {bench}", bench, bench], [1, 2, 2])
    rows = spaced_seeds.overlaps(df, items(spark, [bench, bench])).collect()
    assert sorted((r.doc, r.item, r.first_word, r.end_word) for r in rows) == [
        (1, 0, 0, 30), (1, 0, 130, 160), (1, 1, 0, 30), (1, 1, 130, 160), (2, 0, 0, 30), (2, 1, 0, 30),
    ]


def test_filter_keeps_clean_documents(spark):
    bench = prose(1, 30)
    df = documents(spark, ["clean", f"x {bench}", bench, None, "", prose(5, 50), "clean"], [1, 1, 2, 3, 4, None, 1])
    out = spaced_seeds.decontaminated(df, items(spark, [bench, None, ""]))
    assert out.columns == df.columns
    assert sorted((str(r.doc_id), r.hash) for r in out.collect()) == [("1", 7), ("1", 7), ("3", 7), ("4", 7), ("None", 7)]


def test_few_substitutions_at_all_places():
    """Items of 13 to 20 words with one to three substitutions count, wherever these are, as long as four of five agree."""
    for size in range(13, 21):
        for many in range(1, 4):
            if 5 * many <= size:
                for places in itertools.combinations(range(size), many):
                    same = np.ones(size, bool)
                    same[list(places)] = False
                    assert spaced_seeds.similar_runs(same, 13, (True, True)) == [(0, size)]


def test_similar_runs_against_brute_force():
    draw = random.Random(6)
    for _ in range(300):
        same = np.array([draw.random() < 0.75 for _ in range(draw.randint(0, 45))], bool)
        free = (draw.random() < 0.5, draw.random() < 0.5)
        expected = np.zeros(len(same), bool)
        for a, b in itertools.combinations(range(len(same) + 1), 2):
            begin, end = same[a] or (free[0] and a == 0), same[b - 1] or (free[1] and b == len(same))
            if b - a >= 13 and begin and end and 5 * same[a:b].sum() >= 4 * (b - a):
                expected[a:b] = True
        got = np.zeros(len(same), bool)
        for a, b in spaced_seeds.similar_runs(same, 13, free):
            got[a:b] = True
        assert (got == expected).all()


def test_substituted_words_in_documents(spark):
    bench = [prose(500 + k, 16) for k in range(16)] + [prose(600 + k, 13) for k in range(2)]
    texts = [t.split() for t in bench]
    for k, at in [*[(k, k) for k in range(16)], (16, 0), (17, 12)]:
        texts[k][at] = "changed"
    df = documents(spark, [f"{prose(700 + k, 30)} {' '.join(t)} {prose(800 + k, 30)}" for k, t in enumerate(texts)])
    assert set(found(df, items(spark, bench))) == {(k, k) for k in range(18)}


def test_odd_rows(spark):
    df = nasty(spark)
    bench = items(spark, [prose(1, 40_000), None, "", "x"])
    assert set(found(df, bench)) == {(50, 0)}
    assert found(df, bench.limit(0)) == {} and found(df.limit(0), bench) == {}
    assert spaced_seeds.decontaminated(df, bench.limit(0)).count() == df.count()
