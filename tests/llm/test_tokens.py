from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st

from forecourt.llm import tokens
from forecourt.llm.kneser_ney import unmix

TEXTS = st.lists(st.text(st.sampled_from(list("ab A\n\t\x0b é.,0")), max_size=30), max_size=6)


@hypothesis_settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    data = [t.encode() for t in texts]
    found = tokens.words(data)
    expected = [[m for m in re.findall(rb"[^\x20\x09-\x0D]+", t)] for t in data]
    spelled = [data[t][s:e] for t, s, e in zip(found.text, found.start, found.end, strict=True)]
    assert spelled == [w for ws in expected for w in ws]
    assert np.diff(found.first).tolist() == [len(ws) for ws in expected]
    by_hash: dict[int, bytes] = {}
    assert all(by_hash.setdefault(h, w) == w for h, w in zip(found.hash.tolist(), spelled, strict=True))
    assert len(set(found.hash.tolist())) == len(set(spelled))


def test_alphabets():
    def count(alphabet, *texts):
        return len(set(tokens.words([t.encode() for t in texts], alphabet).hash.tolist()))

    assert count(tokens.LOWER, "The the THE") == 1
    assert count(tokens.PLAIN, "The the THE") == 3
    assert count(tokens.LETTERS, "idiot*** Idiot, idiot9") == 1
    assert count(tokens.ALNUM, "a1, A1. a 1") == 3


def test_ngrams_stay_inside_a_text():
    found = tokens.words([b"a b c", b"", b"d", b"a b"])
    grams, at = found.ngrams(2)
    assert at.tolist() == [0, 1, 4] and grams[0] == grams[2] != grams[1]


@given(st.integers(0, 2**64 - 1))
def test_mix_is_reversible(x):
    value = np.array([x], np.uint64)
    assert unmix(tokens.mix(value)) == value


@pytest.mark.parametrize("size", [1, 5, 1000])
def test_pieces_keep_all_rows(size):
    batch = pa.RecordBatch.from_arrays([pa.array(["abc", None, "", "x" * 50, "de"])], names=["text"])
    parts = list(tokens.pieces([batch], size))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
