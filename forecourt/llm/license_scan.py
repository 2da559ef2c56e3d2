"""License notices, found by conditional compression.

Text that repeats a license compresses much better when the license text is the compressor's dictionary.

1. Runs of four words that a template has as well say where in a text it may stand. A notice with as many differing
   words as are allowed still has such runs, and enough of them on neighbouring diagonals, so no candidate is lost.
   A candidate block is as long as the template that suggests it, so sizes are always measured at one scale.
2. Every block is compressed alone and with each template as raw dictionary. The templates are ranked by what they save.
3. From the best on, templates are confirmed by their wording, word by word, in what better ones left of the block.
"""

from __future__ import annotations

import difflib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.tokens import ALNUM, encoded, pieces, words

# Wordings of license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
    "in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
    'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
    "specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with "
    "the distribution.",
    "BSD-3-Clause-line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
    "above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software.",
    "AGPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
    "your option) any later version.",
    "BSD-3-Clause-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written permission.",
    "BSD-disclaimer": "This software is provided by the copyright holders and contributors \"as is\" and any express or implied "
    "warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular "
    "purpose are disclaimed.",
    "BSL-1.0-notice": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
    "software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
    "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit "
    "third-parties to whom the Software is furnished to do so",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "EPL-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License 2.0 which is available at",
    "GPL-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
    "option) any later version.",
    "LGPL-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
    "your option) any later version.",
    "Unlicense-notice": "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
    "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
    "for any purpose, commercial or non-commercial, and by any means.",
    "Zlib-notice": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
    "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
    "for any purpose, including commercial applications, and to alter it and redistribute it freely",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
NAMES = {
    "AGPL-3.0": "GNU Affero General Public License",
    "Apache-2.0": "Apache License",
    "Artistic-2.0": "Artistic License 2.0",
    "BSD-2-Clause": "BSD 2-Clause License",
    "BSD-3-Clause": "BSD 3-Clause License",
    "BSL-1.0": "Boost Software License",
    "EPL-2.0": "Eclipse Public License 2.0",
    "EUPL-1.2": "European Union Public Licence",
    "GPL": "GNU General Public License",
    "ISC": "ISC License",
    "LGPL": "GNU Lesser General Public License",
    "MIT": "MIT License",
    "MPL-2.0": "Mozilla Public License 2.0",
    "Unlicense": "Unlicense",
    "Zlib": "zlib License",
}
# short notices: every name after every beginning, and the identifier line
OPENINGS = ("Distributed", "Licensed", "Released", "Available")
for _id, _name in NAMES.items():
    for _opening in OPENINGS:
        _text = f"{_opening} under the {_name}"
        if f"{_text}." not in TEMPLATES.values():
            TEMPLATES[f"{_id}-{_opening.lower()}"] = _text
    TEMPLATES[f"{_id}-identifier"] = f"SPDX-License-Identifier: {_id}"

LEVEL, MOST_DIFFERENT, GRAM = 3, 0.1, 4


@dataclass
class Bank:
    """Templates ready for use: names, words, compressors, and where which runs of words stand in them."""

    plain: object
    names: list[str]
    wordings: list[list[int]]
    counts: list[Counter]
    coders: list
    grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by size: hashes in order, template, place


def normal(text: bytes, starts: list[int], ends: list[int]) -> bytes:
    """The words of a block in lower case with single blanks: what is compressed."""
    return b" ".join(text[a:b] for a, b in zip(starts, ends, strict=True)).lower()


@lru_cache(maxsize=4)
def bank(templates: tuple[tuple[str, str], ...]) -> Bank:
    """Templates without a word are left out."""
    import zstandard

    frame = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
    found = Bank(zstandard.ZstdCompressor(**frame), [], [], [], [], {})
    grams: dict[int, list[tuple[int, int, int]]] = {}
    for name, text in templates:
        data = text.encode("utf-8", "replace")
        own = words([data], ALNUM)
        if not len(own.hash):
            continue
        raw = zstandard.ZstdCompressionDict(normal(data, own.start.tolist(), own.end.tolist()), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=LEVEL)
        size = min(GRAM, len(own.hash))
        hashes, at = own.ngrams(size)
        grams.setdefault(size, []).extend((h, len(found.names), q) for h, q in zip(hashes.tolist(), at.tolist(), strict=True))
        found.names.append(name)
        found.wordings.append(own.hash.tolist())
        found.counts.append(Counter(own.hash.tolist()))
        found.coders.append(zstandard.ZstdCompressor(dict_data=raw, **frame))
    for size, rows in grams.items():
        rows.sort()
        found.grams[size] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    return found


def candidates(found, known: Bank) -> Iterator[tuple[int, int, int]]:
    """Text, first word and word after the last of every block that may hold a notice.

    A template of L words with at most D differences keeps at least ``L - 3 - 4 D`` of its runs of four words, on diagonals
    that lie at most D apart. A block covers diagonals up to L apart and overlaps with the next one by D.
    """
    parts = []
    for size, (hashes, template, place) in known.grams.items():
        own, at = found.ngrams(size)
        low = np.searchsorted(hashes, own)
        hit = np.flatnonzero(hashes[np.minimum(low, len(hashes) - 1)] == own)
        low, high = low[hit], np.searchsorted(hashes, own[hit], side="right")
        many = high - low
        entry = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        text = np.repeat(found.text[at[hit]], many)
        where = np.repeat(at[hit], many) - found.first[text]
        parts.append(np.column_stack([text, template[entry], where - place[entry], place[entry]]))
    rows = np.concatenate(parts) if parts else np.zeros((0, 4), np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    edges = np.flatnonzero(np.any(np.diff(rows[:, :2], axis=0) != 0, axis=1)) + 1 if len(rows) else []
    blocks = set()
    for group in np.split(rows, edges) if len(rows) else []:
        text, template, diagonals, places = int(group[0, 0]), int(group[0, 1]), group[:, 2], group[:, 3]
        length = len(known.wordings[template])
        most = int(MOST_DIFFERENT * length)
        size = min(GRAM, length)
        need = max(1, length - size + 1 - size * most)
        total = int(found.first[text + 1] - found.first[text])
        at = 0
        while at < len(group):
            end = int(np.searchsorted(diagonals, diagonals[at] + length, side="right"))
            if end - at >= need and len(np.unique(places[at:end])) >= need:
                blocks.add((text, max(0, int(diagonals[at])), min(total, int(diagonals[end - 1]) + length)))
            if end == len(group):
                break
            at = int(np.searchsorted(diagonals, diagonals[at] + length - most))
    yield from sorted(blocks)


def closest(block: list[str], template: list[str]) -> tuple[int, int, int, difflib.Match] | None:
    """The densest run of matches: differences, first word, word after the last; and the longest equal run."""
    same = [b for b in difflib.SequenceMatcher(None, template, block, autojunk=False).get_matching_blocks() if b.size]
    if not same:
        return None
    # words far apart are no wording: keep the densest run of matches
    different, i, j = min(
        (
            (len(template) - sum(b.size for b in same[i:j]) + (same[j - 1].b + same[j - 1].size - same[i].b) - sum(b.size for b in same[i:j]), i, j)
            for i in range(len(same))
            for j in range(i + 1, len(same) + 1)
        )
    )
    return different, same[i].b, same[j - 1].b + same[j - 1].size, max(same, key=lambda b: b.size)


def wording(block: list[str], template: list[str]) -> list[tuple[int, int, int]]:
    """Places where the block has the template's words in order: first word, word after the last, differences.

    Differences are words of the template that are missing and words in between that it doesn't have.
    The closest place comes first; the search goes on to its left and right. Where it is too different, the stretch of
    the template's length around the longest equal run is compared by itself, then what is on either side of that run.
    """
    out, todo = [], [(0, len(block))]
    most = int(MOST_DIFFERENT * len(template))
    # so many differences leave a run of at least so many equal words
    least_run = (len(template) - most) / (most + 1)
    while todo:
        low, high = todo.pop()
        found = closest(block[low:high], template) if high - low >= len(template) - most else None
        if not found:
            continue
        different, first, end, run = found
        start = low
        if different > MOST_DIFFERENT * len(template):
            if run.size < least_run:
                continue
            start, stop = max(low, low + run.b - run.a - most), min(high, low + run.b - run.a + len(template) + most)
            near = closest(block[start:stop], template)
            if not near or near[0] > MOST_DIFFERENT * len(template):
                todo += [(low, low + run.b), (low + run.b + run.size, high)]
                continue
            different, first, end, _ = near
        out.append((start + first, start + end, different))
        todo += [(low, start + first), (start + end, high)]
    return sorted(out)


def ranked(block: bytes, known: Bank) -> list[int]:
    """Templates by what they save when the block is compressed, the best first, then by name; without those that save nothing."""
    alone = len(known.plain.compress(block))
    saved = [(alone - len(coder.compress(block)), k) for k, coder in enumerate(known.coders)]
    return [k for gain, k in sorted(saved, key=lambda s: (-s[0], known.names[s[1]])) if gain > 0]


def scan_texts(texts: list[bytes], known: Bank) -> list[tuple]:
    """Notices: text, start, end, name, size alone, size with the template, differing words."""
    found = words(texts, ALNUM)
    confirmed: dict[int, set[tuple]] = {}
    for text, first, after in candidates(found, known):
        origin = int(found.first[text])
        span = slice(origin + first, origin + after)
        own, starts, ends = (x[span].tolist() for x in (found.hash, found.start, found.end))
        held = Counter(own)
        free = [(0, len(own))]
        for k in ranked(normal(texts[text], starts, ends), known):
            template = known.wordings[k]
            # without so many of its words no place can have the wording
            if sum((held & known.counts[k]).values()) < (1 - MOST_DIFFERENT) * len(template):
                continue
            left = []
            for low, high in free:
                at = low
                for a, b, different in wording(own[low:high], template):
                    a, b = low + a, low + b
                    place = normal(texts[text], starts[a:b], ends[a:b])
                    sizes = len(known.plain.compress(place)), len(known.coders[k].compress(place))
                    confirmed.setdefault(text, set()).add((sizes[1] - sizes[0], different, known.names[k], first + a, first + b, *sizes))
                    left.append((at, a))
                    at = b
                left.append((at, high))
            free = [(a, b) for a, b in left if a < b]
    out = []
    for text, places in confirmed.items():
        # characters before each byte
        characters = np.concatenate(([0], np.cumsum(np.frombuffer(texts[text], np.uint8) & 0xC0 != 0x80)))
        origin = int(found.first[text])
        taken: list[tuple[int, int]] = []
        for _, different, name, first, after, alone, size in sorted(places):
            if all(after <= a or first >= b for a, b in taken):
                taken.append((first, after))
                start, end = found.start[origin + first], found.end[origin + after - 1]
                out.append((text, int(characters[start]), int(characters[end]), name, alone, size, different))
    return sorted(out)


def scan(df: DataFrame, key: str = "doc_id", templates: dict[str, str] | None = None) -> DataFrame:
    """One row per notice: key, ``start``, ``end`` (characters), ``license``, ``plain_bytes``, ``dict_bytes``,
    ``reduction`` and ``differences``, the number of words in which it departs from the template.

    Null and empty texts have no notice; a notice repeated in a text is found each time; overlapping places go to the one whose
    template saves most bytes there, ties to fewer differences, then the name. Repeated rows each give their notices. Words are runs of
    letters and digits without regard to ASCII case. All texts are read whole. An empty table gives none.
    """
    chosen = tuple(sorted((templates or TEMPLATES).items()))
    if key.lower() in ("start", "end", "license", "plain_bytes", "dict_bytes", "differences", "reduction"):
        raise ValueError(f"the key {key} is called like a column of the result")
    kind = dict(df.dtypes)[key]
    names = ["key", "start", "end", "license", "plain_bytes", "dict_bytes", "differences"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bank(chosen)
        for batch in pieces(batches):
            found = scan_texts(encoded(batch.column("text")), known)
            columns = [batch.column("key").take(pa.array([f[0] for f in found], pa.int64()))]
            columns += [pa.array([f[n + 1] for f in found], t) for n, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    shape = f"key {kind}, start bigint, end bigint, license string, plain_bytes bigint, dict_bytes bigint, differences bigint"
    found = df.select(F.col(key).alias("key"), F.col("text")).mapInArrow(run, shape)
    out = found.withColumn("reduction", 1 - F.col("dict_bytes") / F.col("plain_bytes"))
    return out.select(F.col("key").alias(key), *[c for c in out.columns if c != "key"])
