from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st

from forecourt.llm import byte_bpe
from tests.llm.cases import documents, nasty, prose

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def judge():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


@hypothesis_settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(st.sampled_from(list(" \n\t\r\x0b\x85\xa0 'sSdt10²½aàé文😀́\x1c​_-")), max_size=40))
def test_same_ids_as_the_ranks(judge, text):
    coder = byte_bpe.tokenizer(PATH, public_tokenizers.PATTERN)
    ids = coder.encode(text, add_special_tokens=False).ids
    assert ids == judge.encode_ordinary(text)
    assert byte_bpe.decode_ids(ids, PATH) == text.encode()


def test_long_pieces(judge):
    coder = byte_bpe.tokenizer(PATH, public_tokenizers.PATTERN)
    for text in ("a" * 5000, "ab" * 3000, " " * 4000, "é" * 3000, "=-" * 900, prose(1, 1).strip() * 800, "lalalalala" * 300, "0" * 3000):
        assert coder.encode(text, add_special_tokens=False).ids == judge.encode_ordinary(text)


def test_table_is_a_bijection():
    shown = byte_bpe.byte_characters()
    assert len(set(shown)) == 256 and all(c.isprintable() and not c.isspace() for c in shown)
    ranks = byte_bpe.read_ranks(PATH)
    assert all(byte_bpe.token_bytes(PATH)[r] == t for t, r in ranks.items())


def test_offsets_and_decoding(spark):
    df = documents(spark, ["naïve 文字 😀 end", None, "", "a\x00b"])
    coded = byte_bpe.encode(df, PATH, public_tokenizers.PATTERN)
    for r in byte_bpe.decode(coded, PATH).collect():
        text = r.text or ""
        assert r.decoded == text and r.hash == 7
        assert len(r.ids) == len(r.starts) == len(r.ends)
        covered = {k for s, e in zip(r.starts, r.ends, strict=True) for k in range(s, e)}
        assert covered == set(range(len(text)))
    split = spark.createDataFrame([([byte_bpe.read_ranks(PATH)[b"\xf0"]],), (None,)], "ids array<int>")
    assert [r.decoded for r in byte_bpe.decode(split, PATH).collect()] == ["�", None]


def test_odd_rows(spark, judge):
    df = nasty(spark)
    for r, text in zip(byte_bpe.round_trip(df, PATH, public_tokenizers.PATTERN).collect(), [r.text for r in df.collect()], strict=True):
        ids = judge.encode_ordinary(text or "")
        assert (r.n_tokens, r.hash) == (len(ids), 7)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert byte_bpe.round_trip(df.limit(0), PATH, public_tokenizers.PATTERN).collect() == []
