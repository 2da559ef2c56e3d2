from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.llm import aligned_lines
from forecourt.llm.tokens import words
from tests.llm.cases import documents, nasty, prose


def spans(df, **options):
    return {(r.rank, r.first, r.start, r.end) for r in aligned_lines.aligned(df, **options).collect()}


def test_passage_pasted_into_a_line(spark):
    """A passage is deleted from all later documents, wherever it stands in their lines."""
    passage = prose(99, 52)
    texts = [f"{prose(k, 30 + 7 * k)} {passage} {prose(100 + k, 20)}" for k in range(40)] + [prose(200, 300)]
    found = spans(documents(spark, texts))
    # Lines at the edges may be cut differently in the first document, and link later ones with each other.
    assert {f[0] for f in found if f[1] == 0} == set(range(1, 40)) and all(f[1] < f[0] for f in found)
    for rank, _, start, end in found:
        # One byte per word decides how far a block grows: one word in 256 agrees by chance.
        assert 0 <= 30 + 7 * rank - start <= 2 and 0 <= end - (30 + 7 * rank + 52) <= 2


def test_cutting(spark):
    passage = prose(99, 60).replace(" ", "\n", 3)
    df = documents(spark, [f"first {passage}", f"before {passage}\n after", passage, "short copy", "short copy", None])
    out = {r.doc_id: r for r in aligned_lines.without_repeats(df).collect()}
    assert sorted(out) == [0, 1, 3, 4, 5]  # the third document held nothing else
    assert out[0].text == f"first {passage}" and out[1].text == "before after" and out[4].text == "short copy"
    assert out[5].text is None and out[1].hash == 7 and out[1].shard == "mine"


def test_all_shared_windows_are_found(spark):
    """Brute force: every run of 51 words that an earlier document has is deleted from the later one."""
    draw = random.Random(5)
    base = [prose(k, 51 + 9 * k).split() for k in range(6)]
    texts = []
    for k in range(60):
        parts = []
        for _ in range(draw.randint(1, 3)):
            parts += draw.choice(base) + prose(1000 + 7 * k + len(parts), draw.randint(0, 9)).split()
        texts.append(" ".join(parts))
    deleted = {k: set() for k in range(60)}
    for rank, first, start, end in spans(documents(spark, texts)):
        deleted[rank] |= set(range(start, end))
        assert first < rank
    seen: dict[tuple, int] = {}
    missed = total = 0
    for k, text in enumerate(texts):
        w = text.split()
        for at in range(len(w) - 50):
            run = tuple(w[at : at + 51])
            if seen.setdefault(run, k) < k:
                total += 1
                missed += not set(range(at, at + 51)) <= deleted[k]
    assert total > 100 and missed <= 0.01 * total


def lost(texts, deleted):
    """Runs of 51 words that an earlier text has, and how many of them aren't deleted whole."""
    seen: dict[tuple, int] = {}
    missed = total = 0
    for k, text in enumerate(texts):
        w = text.split()
        for at in range(len(w) - 50):
            run = tuple(w[at : at + 51])
            if seen.setdefault(run, k) < k:
                total += 1
                missed += not set(range(at, at + 51)) <= deleted[k]
    return missed, total


def covers(df, texts):
    deleted = {k: set() for k in range(len(texts))}
    for rank, first, start, end in spans(df):
        assert first < rank
        deleted[rank] |= set(range(start, end))
    return deleted


def test_edited_copies_lose_nothing(spark):
    """The first document with a line is often a copy whose own edits break the block around it."""
    draw = random.Random(8)
    texts = []
    for group in range(6):
        base = prose(group, 300).split()
        for _ in range(15):
            own = list(base)
            for at in draw.sample(range(300), 4):
                own[at] = prose(draw.randrange(10**9), 1)
            texts.append(" ".join(own))
    draw.shuffle(texts)
    missed, total = lost(texts, covers(documents(spark, texts), texts))
    assert total > 1000 and missed == 0


def test_short_physical_lines(spark):
    """A list of three words per line is found wherever it stands."""
    words_of = prose(77, 180).split()
    listed = "\n".join(" ".join(words_of[k : k + 3]) for k in range(0, 180, 3))
    texts = [f"{prose(100 + k, 11 + k)}\n{listed}\n{prose(200 + k, 9)}" for k in range(12)]
    missed, total = lost(texts, covers(documents(spark, texts), texts))
    assert total == 11 * 130 and missed == 0


def test_repeated_words(spark):
    """Words that repeat are found at any offset and in any length, with other words around them or none."""
    draw = random.Random(4)
    texts = []
    for k in range(24):
        cycle = ["and", "and so", "a b c", "p q r s", "t u t v", "k k l k k m n"][k % 6].split()
        turned = draw.randrange(len(cycle))
        own = [cycle[(turned + j) % len(cycle)] for j in range(draw.randint(55, 400))]
        around = [prose(300 + k, draw.randint(0, 40)), " ".join(own), prose(400 + k, draw.randint(0, 40))]
        texts.append(" ".join(around) if k % 4 else " ".join(own))
    missed, total = lost(texts, covers(documents(spark, texts), texts))
    assert total > 500 and missed == 0


def test_patience_keeps_the_order():
    a = "x a b c d y".split()
    b = "a b q c d z".split()
    number = {w: k for k, w in enumerate("abcdqrxyz")}
    lines = lambda t: [(k, number[w]) for k, w in enumerate(t)]
    marks = lambda t: np.array([number[w] for w in t], np.uint8)
    assert aligned_lines.patience(lines(a), lines(b), marks(a), marks(b)) == [(1, 0, 2), (3, 3, 2)]
    same = ["r"] * 5
    assert aligned_lines.patience(lines(same), lines(same[:3]), marks(same), marks(same[:3])) == [(0, 0, 3)]
    assert aligned_lines.patience([], [], marks(a), marks(b)) == []
    assert aligned_lines.increasing([(0, 3), (1, 1), (2, 2), (3, 0), (4, 5)]) == [(1, 1), (2, 2), (4, 5)]


@pytest.mark.parametrize("text", ["", "a", "a " * 500, prose(3, 400), "\n".join("abcdefgh")])
def test_lines_cover_the_text(text):
    found = words([b"before", text.encode(), b"after"])
    starts = aligned_lines.line_starts(found, [b"before", text.encode(), b"after"])
    assert {0, len(found.hash) - 1} <= set(starts.tolist())
    assert np.diff(np.concatenate((starts, [len(found.hash)]))).max() <= max(aligned_lines.FORCED, 64)


def test_lines_are_cut_alike_in_any_place():
    passage = prose(9, 60)
    sets = []
    for other in range(5):
        text = f"{prose(20 + other, 11 + other)} {passage} {prose(40 + other, 8)}".encode()
        found = words([text])
        starts = aligned_lines.line_starts(found, [text]).tolist()
        spelled = [text[found.start[a] : found.end[b - 1]] for a, b in zip(starts, [*starts[1:], len(found.hash)], strict=True)]
        sets.append({s for s in spelled if len(re.findall(rb"\S+", s)) >= aligned_lines.LINE_WORDS})
    assert len(set.intersection(*sets)) >= 2


def test_odd_rows(spark):
    df = nasty(spark)
    assert spans(df) == set()
    assert aligned_lines.without_repeats(df).count() == df.count()
    assert aligned_lines.without_repeats(df.limit(0)).collect() == []
    copies = documents(spark, [prose(1, 60)] * 4, [7, 7, None, 9])
    found = spans(copies)
    assert {(min(rank, aligned_lines.NO_ID), *rest) for rank, *rest in found} == {(9, 7, 0, 60), (aligned_lines.NO_ID, 7, 0, 60)}
    assert sorted(r.doc_id for r in aligned_lines.without_repeats(copies).collect()) == [7, 7]


def test_documents_without_a_number_are_documents_of_their_own(spark):
    passage = prose(99, 120)
    texts = [f"{prose(k, 20)} {passage}" for k in range(4)]
    missing = documents(spark, texts, [None] * 4)
    assert len({rank for rank, *_ in spans(missing)}) == 3 and min(rank for rank, *_ in spans(missing)) > aligned_lines.NO_ID
    left = [r.text for r in aligned_lines.without_repeats(missing).collect()]
    assert sum(passage in t for t in left) == 1 and len(left) == 4
    named = documents(spark, texts).withColumn("doc_id", F.concat(F.lit("page-"), "doc_id"))
    kept = {r.doc_id: r.text for r in aligned_lines.without_repeats(named).collect()}
    assert len(kept) == 4 and sum(passage in t for t in kept.values()) == 1


def test_blocks_of_a_text_cover_it_without_being_many(spark):
    """Edited copies share parts with all earlier copies; what is returned doesn't grow with their number."""
    base = prose(5, 400).split()
    texts = []
    for k in range(30):
        own = list(base)
        own[(37 * k) % 400] = f"edit{k}"
        texts.append(" ".join(own))
    found = spans(documents(spark, texts))
    per_text = [sum(rank == k for rank, *_ in found) for k in range(30)]
    assert per_text[0] == 0 and max(per_text) <= 4
    earlier: set[tuple] = set()
    for k, text in enumerate(texts):
        runs = [tuple(text.split()[at : at + 50]) for at in range(351)]
        wanted = set().union(*(range(at, at + 50) for at, run in enumerate(runs) if run in earlier))
        assert wanted <= set().union(*(range(s, e) for rank, _, s, e in found if rank == k))
        earlier |= set(runs)
    assert aligned_lines.cover([[1, 0, 60], [2, 0, 50], [3, 20, 70], [4, 55, 130], [5, 200, 260]]) == [(1, 0, 60), (4, 55, 130), (5, 200, 260)]


def test_repeated_rows_are_one_candidate(spark):
    """Copies of a row are dropped where the lists of lines are joined, not carried to every later step."""
    texts = [prose(1, 120), *[f"{prose(1, 120)} {prose(2, 20)}"] * 5, prose(3, 90)]
    docs = documents(spark, texts, [1, 2, 2, 2, 2, 2, 3])
    plain = docs.selectExpr("doc_id as rank", "md5(text) as print", "text").selectExpr("rank", "unhex(print) as print", "text")
    found = aligned_lines.candidates(aligned_lines.sequences(plain, 5), 5, 50)
    assert sorted(r.rank for r in found.collect()) == [1, 2]


def test_texts_of_one_id(spark):
    """Different texts with one id have their lists of shared lines in common, but each has its own blocks."""
    one, two = prose(11, 90), prose(12, 80)
    texts = [f"{one} {prose(13, 9)} {two}", f"{prose(14, 12)} {one}", f"{two} {prose(15, 7)}", prose(16, 70), "short"]
    left = {r.text for r in aligned_lines.without_repeats(documents(spark, texts, [0, 5, 5, 5, 5])).collect()}
    assert left >= {texts[0], texts[3], "short"} and len(left) == 5
    assert not any(part in t for part in (one[100:400], two[100:400]) for t in left - {texts[0]})


def test_runs_of_many_texts_at_once():
    draw = random.Random(3)
    for _ in range(200):
        sizes = [[draw.randint(1, 30) for _ in range(draw.choice([0, 1, 2, 8, 40]))] for _ in range(draw.randint(1, 5))]
        shared = [[n >= 5 and draw.random() < 0.6 for n in own] for own in sizes]
        cuts = np.concatenate(([0], np.cumsum([len(own) for own in sizes])))
        keep, runs, many = aligned_lines.in_long_runs(np.array(sum(shared, []), bool), np.array(sum(sizes, []), np.uint8), cuts, 5, 50)
        wanted, wanted_keep, counts = [], [], []
        for own, flags in zip(sizes, shared, strict=True):
            places = [sum(own[:k]) for k in range(len(own) + 1)]
            kept, found, a = [False] * len(own), [], 0
            while a < len(own):
                b = a
                while b < len(own) and (flags[b] or own[b] < 5):
                    b += 1
                first, end = places[max(a - 2, 0)], places[min(b + 2, len(own))]
                if b > a and end - first >= 50 and any(flags[a:b]):
                    kept[a:b] = flags[a:b]
                    if found and first <= found[-1][1]:
                        found[-1][1] = end
                    else:
                        found.append([first, end])
                a = b + 1
            wanted, wanted_keep, counts = wanted + found, wanted_keep + kept, [*counts, len(found)]
        assert runs.tolist() == wanted and keep.tolist() == wanted_keep and many.tolist() == counts


def test_lines_once():
    lines, long = np.array([7, 3, 7, 9, 3, 3, 7]), np.array([1, 1, 1, 0, 1, 1, 1], bool)
    once, counts, places = aligned_lines.each_once(lines, long, np.array([0, 4, 4, 7]))
    assert once.tolist() == [3, 7, 3, 7] and counts.tolist() == [2, 0, 2] and places.tolist() == [1, 0, 1, -1, 0, 0, 1]


def test_least_runs_of_words_stand_for_windows():
    """A window's least run depends on its own words alone, and there are few of them: one row for many windows."""
    draw = np.random.default_rng(2)
    values = draw.integers(0, 256, 3000).astype(np.uint8)
    at = np.arange(len(values) - 49)
    least = aligned_lines.least_grams(values, at, 50)
    runs = aligned_lines.windows(values, np.arange(len(values) - 37), 38)
    assert least.tolist() == [runs[k : k + 13].min() for k in at]
    assert aligned_lines.least_grams(values[1000:1200], np.arange(151), 50).tolist() == least[1000:1151].tolist()
    assert len(np.unique(least)) < len(at) / 5
