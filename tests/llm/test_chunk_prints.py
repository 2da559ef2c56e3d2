from __future__ import annotations

import hashlib
import random
from itertools import pairwise

import numpy as np
import pytest
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt.llm import chunk_prints as cp
from tests.llm.cases import documents, nasty, prose


def brute_cuts(text: bytes) -> list[int]:
    """Where chunks begin, one byte after the other."""
    table = [int(x) for x in cp._GEAR]
    seen = bytes(cp.WINDOW) + text
    hashes = [sum(table[seen[i + cp.WINDOW - k]] << k for k in range(cp.WINDOW)) % (1 << 16) for i in range(len(text))]
    out, start = [], 0
    while start < len(text):
        out.append(start)
        size = cp.LEAST
        while start + size < len(text) and size < cp.MOST and hashes[start + size - 1] >= (cp.STRICT if size < cp.USUAL else cp.LOOSE):
            size += 1
        start += size
    return out


def test_cuts_are_those_of_a_plain_loop():
    draw = random.Random(3)
    texts = [prose(k, k * 3).encode() for k in range(40)] + [b"", b"x" * 2000, bytes(600), b"ab" * 700, draw.randbytes(5000)]
    assert cp.cuts(texts) == [brute_cuts(t) for t in texts]
    for one in texts:
        assert cp.cuts([one]) == [brute_cuts(one)]
    sizes = np.concatenate([np.diff([*c, len(t)])[:-1] for c, t in zip(cp.cuts(texts), texts, strict=True)])
    assert sizes.min() >= cp.LEAST and sizes.max() <= cp.MOST
    assert 48 < np.mean([len(t) / len(c) for t, c in zip(texts[20:40], cp.cuts(texts[20:40]), strict=True)]) < 80


def test_blocks_change_nothing(monkeypatch):
    texts = [prose(k, 300).encode() for k in range(5)] + [b"y" * 900]
    whole = cp.prints(texts)
    monkeypatch.setattr(cp, "BLOCK", 100)
    assert all(np.array_equal(a, b) for a, b in zip(whole, cp.prints(texts), strict=True))


@hypothesis_settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=400) | st.text(st.sampled_from(list("ab é")), max_size=300).map(str.encode), max_size=5))
def test_equal_chunks_have_equal_digests(texts):
    together = cp.prints(texts)
    for text, found in zip(texts, together, strict=True):
        assert np.array_equal(found, cp.prints([text])[0])
        chunks = {text[a:b] for a, b in pairwise([*brute_cuts(text), len(text)])}
        assert len(found) == len(chunks) and int((found & np.uint64(255)).sum()) == sum(map(len, chunks))
        assert np.array_equal(cp.read(cp.shown(found)), found)


def test_likeness():
    base = prose(1, 2000)
    words = base.split()
    shifted = " ".join(["inserted", *words[:900], "another", *words[900:]])
    one, other, strange = cp.prints([base.encode(), shifted.encode(), prose(2, 2000).encode()])
    assert cp.likeness(one, other) > 0.95 and cp.likeness(one, strange) == 0.0
    part = cp.prints([" ".join(words[500:1000]).encode()])[0]
    assert cp.likeness(part, one) == cp.likeness(one, part) > 0.9
    none = cp.prints([b""])[0]
    assert cp.likeness(none, none) == 1.0 and cp.likeness(none, one) == 0.0 and cp.likeness(one, one) == 1.0


def expected(rows) -> list[tuple]:
    """The rows' results in descending order of id and hash."""
    order = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id, r.h), reverse=True)
    texts = [r.text or "" for r in order]
    out = []
    for k, (r, text) in enumerate(zip(order, texts, strict=True)):
        following = texts[(k + 1) % len(texts)]
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        own, changed, after = cp.prints([text.encode(), new.encode(), following.encode()])
        digest = hashlib.sha256(new.encode()).hexdigest()
        out.append((r.doc_id, len(text), digest, cp.shown(own), cp.shown(changed), cp.likeness(own, changed), cp.likeness(own, after)))
    return sorted(out, key=repr)


def held(df, **options) -> None:
    rows = df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    assert sorted((tuple(r) for r in cp.edit_prints(df, **options).collect()), key=repr) == expected(rows)


def test_every_row_meets_its_successor(spark, settings):
    texts = [prose(k % 90, 5 + k % 50) for k in range(300)]
    ids = random.Random(5).sample(range(10_000), 300)
    df = documents(spark, texts, ids)
    held(df)
    held(df, part_bytes=2000)  # many ranges
    held(df.repartition(7))
    settings(shuffle__partitions=1)
    held(df)


def test_shared_missing_and_textual_ids(spark):
    same = documents(spark, ["one text"] * 40 + [prose(k, 9) for k in range(40)], [7] * 40 + [None] * 40)
    held(same, part_bytes=100)
    held(same.withColumn("doc_id", F.concat(F.lit("é"), F.col("doc_id"))), part_bytes=100)


@pytest.mark.parametrize("n", [1, 2])
def test_few_rows(spark, n):
    held(documents(spark, [prose(k, 30) for k in range(n)]))


def test_odd_rows(spark):
    df = nasty(spark)
    held(df)
    assert cp.edit_prints(df.limit(0)).collect() == []
    out = cp.fingerprints(df.withColumn("fingerprint", F.lit(1)))
    assert out.columns == [*df.columns, "fingerprint"]
    pairs = out.withColumn("near", cp.contained("fingerprint", "fingerprint")).withColumn("none", cp.contained("fingerprint", F.lit(None).cast("string")))
    assert {(r.near, r.none) for r in pairs.collect()} == {(1.0, None)}


def test_halves_are_found_and_others_are_not(spark):
    rows = cp.edit_prints(documents(spark, [prose(k, 400) for k in range(40)])).collect()
    assert min(r.near_edited for r in rows) > 0.4 > 0.05 > max(r.near_next for r in rows)
