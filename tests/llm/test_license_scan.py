from __future__ import annotations

import random

import pytest

from forecourt.llm.license_scan import MOST_DIFFERENT, TEMPLATES, bank, ranked, scan, scan_texts, wording
from forecourt.llm.tokens import ALNUM, words
from tests.llm.cases import documents, nasty, prose


def found(df):
    return {(r.doc_id, r.license, r.differences) for r in scan(df).collect()}


def test_every_template_is_found_alone_and_in_prose(spark):
    names = sorted(TEMPLATES)
    texts = [TEMPLATES[n] for n in names] + [f"{prose(k, 300)} {TEMPLATES[n]} {prose(-k - 1, 300)}" for k, n in enumerate(names)]
    got = found(documents(spark, texts))
    assert {(k, names[k % len(names)], 0) for k in range(len(texts))} <= got
    assert {i for i, _, _ in got} == set(range(len(texts)))


def test_wording_decides(spark):
    mit = TEMPLATES["MIT-notice"]
    changed = mit.replace("deal in the Software", "deal with this Software")
    texts = [
        changed, mit.upper(), mit.replace(" ", "\n"), "The license of this car was lost, and no permission was given.",
        "Released under the BSD License.", f"{TEMPLATES['MIT']}\n{TEMPLATES['MIT']}\n{TEMPLATES['GPL-3.0']}", "a licence to print money",
    ]
    rows = scan(documents(spark, texts)).collect()
    by = {k: sorted((r.license, r.differences) for r in rows if r.doc_id == k) for k in range(len(texts))}
    assert by[0] == [("MIT-notice", 4)] and by[1] == by[2] == [("MIT-notice", 0)]
    assert by[3] == by[4] == by[6] == []
    assert by[5] == [("GPL-3.0", 0), ("MIT", 0), ("MIT", 0)]
    for r in rows:
        assert r.dict_bytes < r.plain_bytes and 0 < r.reduction < 1
        assert texts[r.doc_id][r.start : r.end].lower().split()[-1].strip(".") in mit.lower() + " 3 license"


def test_spans_and_own_templates(spark):
    df = documents(spark, ["x Copyright notice of mine here y"])
    rows = scan(df, templates={"own": "copyright notice of mine here"}).collect()
    assert [(r.license, r.start, r.end) for r in rows] == [("own", 2, 31)]


def test_long_texts_full_of_cue_words(spark):
    """A notice in 5,000 words with a cue word every hundred words is found as anywhere else."""
    names = sorted(TEMPLATES)
    texts = []
    for k, name in enumerate(names):
        own = prose(900 + k, 5000).split()
        own[::100] = ["permission"] * len(own[::100])
        texts.append(" ".join([*own[:2550], TEMPLATES[name], *own[2550:]]))
    assert {(k, name, 0) for k, name in enumerate(names)} <= found(documents(spark, texts))


def test_truncated_copies_hide_no_full_one():
    template = prose(1, 70).split()
    full = [*template[:35], "changed", *template[36:]]
    assert wording([*template[:40], *full], template) == [(40, 110, 2)]
    for cut in range(5, 66, 6):
        for rest in (template[:cut], template[cut:]):
            for block in ([*rest, *full], [*full, *rest], [*rest, *prose(2, 30).split(), *full, *prose(3, 30).split(), *rest]):
                assert any(different <= 2 for _, _, different in wording(block, template))


def test_odd_rows(spark):
    df = nasty(spark)
    assert scan(df).collect() == [] and scan(df.limit(0)).collect() == []
    same = documents(spark, [TEMPLATES["ISC"]] * 2, [5, 5])
    assert [r.license for r in scan(same).collect()] == ["ISC", "ISC"]


def known(templates=TEMPLATES):
    return bank(tuple(sorted(templates.items())))


def test_candidates_against_every_window():
    """What comparing every template with whole texts finds, candidates find as well."""
    draw = random.Random(11)
    names = sorted(TEMPLATES)
    texts = []
    for k in range(60):
        parts = []
        for name in draw.sample(names, 3):
            own = TEMPLATES[name].split()
            for _ in range(draw.randint(0, max(0, len(own) // 15))):
                own.insert(draw.randrange(len(own)), "extra") if draw.random() < 0.5 else own.pop(draw.randrange(len(own)))
            parts += [prose(1000 + k, draw.randint(0, 40)), " ".join(own)]
        texts.append(" ".join(parts).encode())
    table = known()
    got = scan_texts(texts, table)
    for k, text in enumerate(texts):
        own = words([text], ALNUM)
        covered = {at for t, a, b, *_ in got if t == k for at in range(a, b)}
        for template in table.wordings:
            for first, after, different in wording(own.hash.tolist(), template):
                assert different <= MOST_DIFFERENT * len(template)
                # the place itself, or one that saves more and overlaps with it
                assert covered & set(range(int(own.start[first]), int(own.end[after - 1])))


def test_sizes_decide():
    """Two wordings that both fit: the one that saves more is taken, and other sizes give another result."""
    one = "this notice of twelve words says that you may use the thing freely"
    templates = {"a": one.replace("twelve", "eleven twelve"), "b": one}
    table = bank(tuple(templates.items()))
    assert [r[3] for r in scan_texts([one.encode()], table)] == ["b"]

    class Large:
        def compress(self, data):
            return b"x" * 2 * len(data)

    swapped = bank.__wrapped__(tuple(templates.items()))
    swapped.coders[1] = Large()
    assert ranked(one.encode(), table) and [r[3] for r in scan_texts([one.encode()], swapped)] == ["a"]
    swapped.coders[0] = Large()
    assert scan_texts([one.encode()], swapped) == []


def test_templates_without_common_words(spark):
    own = {"house rule": "guests leave their shoes beside the green door", "empty": "...", "short": "all mine forever"}
    df = documents(spark, [f"{prose(1, 200)} Guests leave their shoes beside the green door. {prose(2, 200)} All mine, forever!"])
    assert [(r.license, r.differences) for r in sorted(scan(df, templates=own).collect(), key=lambda r: r.start)] == [("house rule", 0), ("short", 0)]


@pytest.mark.parametrize("line", ["Distributed under the MIT License.", "It is licensed under the MIT License.", "# SPDX-License-Identifier: MIT"])
def test_short_lines(line):
    assert [r[3].split("-")[0] for r in scan_texts([line.encode()], known())] == ["MIT"]


@pytest.mark.parametrize("column", ["start", "end", "license", "reduction"])
def test_keys_of_any_name(spark, column):
    df = documents(spark, [TEMPLATES["ISC"]]).withColumnRenamed("doc_id", "own").selectExpr("own + 3 as own", "text").withColumnRenamed("own", "id")
    assert [r.license for r in scan(df, "id").collect()] == ["ISC"]
    with pytest.raises(ValueError, match=column):
        scan(df.withColumnRenamed("id", column), column)
