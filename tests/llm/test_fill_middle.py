from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st

from forecourt.llm import fill_middle
from tests.llm.cases import documents, nasty, prose

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text: str | None) -> tuple:
    """Units, form, characters of prefix and middle, and output of one text."""
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNITS.findall(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(df) -> int:
    """Compare all rows with the brute force; how many weren't plain."""
    out = fill_middle.restore(fill_middle.transform(df))
    assert out.columns == [*[c for c in df.columns if c not in fill_middle.ADDED], *fill_middle.ADDED, "restored"]
    rows = out.collect()
    for r in rows:
        assert (r.n_units, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, r.text), r.doc_id
        assert r.restored == (r.text or "")
    assert len(rows) == df.count()
    return sum(r.form != "plain" for r in rows)


def test_all_forms(spark):
    texts = [prose(k, k % 40) + (" \n" if k % 7 == 0 else "") for k in range(400)]
    df = documents(spark, texts)
    assert 120 < check(df) < 280
    forms = {r.form for r in fill_middle.transform(df).select("form").collect()}
    assert forms == {"plain", "psm", "spm"}


def test_odd_rows(spark):
    df = nasty(spark)
    check(df)
    check(df.unionByName(documents(spark, [f"naïve 文字 {m} 😀" for m in ("<P>", "<S>", "<M>", "< P>", "<P")] * 8, list(range(100, 140)))))
    assert fill_middle.restore(fill_middle.transform(df.limit(0))).collect() == []


def test_clashing_columns(spark):
    df = documents(spark, ["a b c d e f"] * 30)
    for name in ("form", "output", "restored", "draw1", "n_units"):
        df = df.withColumn(name, df["hash"])
    out = fill_middle.restore(fill_middle.transform(df))
    assert out.columns.count("form") == 1 and {r.draw1 for r in out.collect()} == {7}
    assert {r.restored for r in out.collect()} == {"a b c d e f"}


def test_settings(spark):
    df = documents(spark, [prose(k, 12) for k in range(60)])
    forms = lambda **options: {r.form for r in fill_middle.transform(df, **options).collect()}
    assert forms(plain=0) == {"plain"} and forms(plain=100, spm=100) == {"spm"} and forms(plain=100, spm=0) == {"psm"}
    one = fill_middle.transform(df, plain=100).select("doc_id", "output")
    assert one.exceptAll(fill_middle.transform(df, plain=100, seed=7).select("doc_id", "output")).count() > 40


def test_a_missing_marker_is_an_error():
    data, origin = fill_middle.buffers(pa.array(["<S>a<P>b<M>c", "<S>a<P>b c"]))
    with pytest.raises(ValueError, match="<M>"):
        fill_middle.gathered(data, origin, np.array([2, 2]))


@hypothesis_settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text(st.sampled_from(list("aé文 \n<PSM>")), max_size=25), st.integers(0, 99), st.integers(0, 99), st.sampled_from([1, 2])), max_size=6), st.sampled_from([1, 5, 1 << 20]))
def test_scatter_and_gather_undo_each_other(cases, block):
    texts = [t for t, *_ in cases]
    data, origin = fill_middle.buffers(pa.array(texts, pa.string()).slice(0))
    ends, first = fill_middle.unit_ends(data, origin)
    assert np.diff(first).tolist() == [len(UNITS.findall(t)) for t in texts]
    bounds = np.concatenate(([0], ends))
    n = np.diff(first)
    picked = [np.array([c[k] for c in cases], np.int64) % (n + 1) for k in (1, 2)]
    low, high = np.minimum(*picked), np.maximum(*picked)
    form = np.array([0 if any(m in c[0] for m in ("<P>", "<S>", "<M>")) else c[3] for c in cases], np.int64)
    before, fill_middle.BLOCK = fill_middle.BLOCK, block
    try:
        cuts = [np.where(k > 0, bounds[first[:-1] + k], origin[:-1]) for k in (low, high)]
        output, out = fill_middle.scattered(data, origin, *cuts, form)
        back, again = fill_middle.gathered(output, out, form)
    finally:
        fill_middle.BLOCK = before
    assert fill_middle.texts(back, again).to_pylist() == texts
    for text, unit, a, b, kind, shown in zip(texts, map(UNITS.findall, texts), low, high, form, fill_middle.texts(output, out).to_pylist(), strict=True):
        p, m, s = "".join(unit[:a]), "".join(unit[a:b]), "".join(unit[b:])
        assert shown == (text, f"<P>{p}<S>{s}<M>{m}", f"<S>{s}<P>{p}<M>{m}")[kind]
