"""Line deduplication by pairwise alignment.

Passages are often pasted into the middle of a line, and lists, verse and tables have lines of few words, so texts are
cut by their words alone: after a word whose pair hash is smaller than those of four words on
either side. Equal passages are then cut alike wherever they stand, and hold whole lines of about
nine words in common: a passage of 51 words holds at least one with a probability of 0.9999.

1. Every text is a sequence of line hashes. Lines of five words or more say something. A block of fifty words
   consists of lines that several documents have, and at most of the two lines before and after them; so
   documents in which no run of shared lines is long enough are left out, and so are all other lines.
2. A line links each document that is left to the first of them that has it. That is one link per
   occurrence, however many documents share the line: no pairs of a group are made.
3. Linked documents are aligned with patience diff: lines that occur once in both are anchors where their
   order agrees, anchors grow word by word as far as the documents agree, and gaps between them are
   aligned in the same way.
4. An earlier document with a line need not have the block around it, as among edited copies. So every window
   of fifty words that has a part outside all blocks is looked up in all documents that are left, and is a
   block if an earlier one has it. That is one row per window, however many documents share it.
5. Blocks of enough words are deleted from the later document. The first document with a block keeps it,
   so nothing is lost from the corpus.

Of the words of a text, one byte each travels along, with which blocks grow over the rest of a line
that was cut off, and by which windows are chosen; whether windows agree the words themselves decide.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import fingerprint, fresh, written
from forecourt.llm.spaced_seeds import _probes, bit_table
from forecourt.llm.tokens import Words, _power, combine, encoded, mix, pieces, words

WINDOW, FORCED, REPEATED = 4, 64, 8  # words compared on either side of a cut; longest line; least line of words that repeat
LINE_WORDS, BLOCK_WORDS = 5, 50
LAST = (1 << 63) - 1
NO_ID = LAST - (1 << 40)  # ranks above stand for documents without an id
AT_ONCE = 1 << 17  # windows that a task holds

BLOCKS = "rank bigint, print binary, first bigint, start bigint, end bigint"

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def line_starts(found: Words, texts: list[bytes]) -> np.ndarray:
    """First words of all lines: of each text, and where the pair hash of the words before is a strict minimum."""
    n = len(found.hash)
    if not n:
        return np.zeros(0, np.int64)
    first = np.zeros(n, bool)
    first[found.first[:-1][np.diff(found.first) > 0]] = True
    pair = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    pair[:-1] = combine([found.hash[:-1], found.hash[1:]], 7)
    least, tied = np.zeros(n, bool), np.zeros(n, bool)
    # neighbours must be in the same text; a cut near its ends would depend on what isn't there
    least[WINDOW : n - WINDOW] = found.text[2 * WINDOW :] == found.text[: max(n - 2 * WINDOW, 0)]
    tied[:] = least
    for d in range(1, WINDOW + 1):
        less, more = pair[d:] < pair[:-d], pair[d:] > pair[:-d]
        least[d:] &= less
        least[:-d] &= more
        tied[d:] &= ~more
        tied[:-d] &= ~less
    first[1:] |= least[:-1]
    # Words that repeat have no strict minimum, but equal ones once in each period: every so many of these cut, from the
    # first of them on, so that lines of one repetition are equal, wherever it is entered.
    chain = np.flatnonzero(tied[:-1] & ~least[:-1]) + 1
    before, new = -1, -1
    for at in chain.tolist():
        if before < 0 or at - before > WINDOW or found.text[at] != found.text[before] or at - new >= REPEATED:
            first[at], new = True, at
        before = at
    starts = np.flatnonzero(first)
    sizes = np.diff(np.concatenate((starts, [n])))
    long = np.flatnonzero(sizes > FORCED)
    if len(long):  # hashes that rise or fall for so long have no minimum
        extra = [np.arange(starts[k] + FORCED, starts[k] + sizes[k], FORCED) for k in long.tolist()]
        starts = np.sort(np.concatenate([starts, *extra]))
    return starts


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a list or binary column without nulls, and the place of each row's first; one more entry at the end."""
    if pa.types.is_list(column.type):
        cuts = column.offsets.to_numpy().astype(np.int64)
        return column.values.to_numpy()[cuts[0] : cuts[-1]], cuts - cuts[0]
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int64)))


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list column from the values of all rows and their number in each."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values))


def binaries(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A binary column from the values of all rows and the place of each row's first; one more entry at the end."""
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def each_once(lines: np.ndarray, long: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different long lines of each text, their number, and for every line its place among those of its text; -1 for a short one."""
    count = len(cuts) - 1
    at = np.flatnonzero(long)
    text = np.repeat(np.arange(count), np.diff(cuts))[at]
    order = np.lexsort((lines[at], text))
    at, text = at[order], text[order]
    found = lines[at]
    new = np.ones(len(at), bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    counts = np.bincount(text[new], minlength=count)
    places = np.full(len(lines), -1, np.int32)
    places[at] = np.cumsum(new) - 1 - (np.cumsum(counts) - counts)[text]
    return found[new], counts, places


def sequences(docs: DataFrame, least_line: int) -> DataFrame:
    """Per text: hashes of its lines of ``least_line`` words, each once; of all lines in order, where the hash stands among
    these (-1: too short) and the number of words, a byte each; and one byte per word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = encoded(batch.column("text"))
            found = words(texts)
            starts = line_starts(found, texts)
            sizes = np.diff(np.concatenate((starts, [len(found.hash)])))
            sums = np.zeros(len(found.hash) + 1, np.uint64)
            np.cumsum(found.hash * _power("up", len(found.hash)), out=sums[1:])
            lines = mix((sums[starts + sizes] - sums[starts]) * _power("down", len(sums))[starts] + sizes.astype(np.uint64))
            marks = (found.hash >> np.uint64(56)).astype(np.uint8)
            cuts = np.searchsorted(starts, found.first)
            once, counts, places = each_once(lines.view(np.int64), sizes >= least_line, cuts)
            columns = [lists(once, counts), binaries(places, cuts), binaries(sizes.astype(np.uint8), cuts), binaries(marks, found.first)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rank"), batch.column("print"), *columns], names=["rank", "print", "lines", "places", "sizes", "marks"]
            )

    return docs.mapInArrow(run, "rank bigint, print binary, lines array<bigint>, places binary, sizes binary, marks binary")


def shared_lines(parts: DataFrame) -> DataFrame:
    """Lines that several documents have, with the first of them, from rows (rank, line).

    A line that very many documents have is a minimum and a maximum, made with partial aggregates. There is one row per
    line, so joins can hash these rows and needn't sort the occurrences.
    """
    found = parts.groupBy("line").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    return found.filter("first < last").drop("last")


def in_long_runs(
    shared: np.ndarray, sizes: np.ndarray, cuts: np.ndarray, least_line: int, least_words: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which shared lines of many texts are in a run that a block of ``least_words`` words could be made of, the first word
    and the word after the last of all such runs, with the lines at their ends, and the number of these in each text.

    A run goes on over lines that are too short to be compared. At its ends, words outside the block decide how
    the last words inside are cut: one line there can lie in the block and yet differ, and of a second one a part.
    """
    before = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    edge = np.zeros(len(sizes) + 1, bool)
    edge[cuts] = True
    open_ = np.concatenate(([False], shared | (sizes < least_line), [False]))
    a = np.flatnonzero(open_[1:-1] & (edge[:-1] | ~open_[:-2]))
    b = np.flatnonzero(open_[1:-1] & (edge[1:] | ~open_[2:])) + 1
    text = np.searchsorted(cuts, a, side="right") - 1
    first, end = before[np.maximum(a - 2, cuts[text])], before[np.minimum(b + 2, cuts[text + 1])]
    seen = np.concatenate(([0], np.cumsum(shared)))
    good = (end - first >= least_words) & (seen[b] > seen[a])
    a, b, text, first, end = a[good], b[good], text[good], first[good], end[good]
    steps = np.zeros(len(sizes) + 1, np.int8)
    steps[a] += 1
    steps[b] -= 1
    inside = np.cumsum(steps[:-1], dtype=np.int8).astype(bool)
    # runs that overlap are one
    new = np.ones(len(a) + 1, bool)
    new[1:-1] = (text[1:] != text[:-1]) | (first[1:] > end[:-1])
    new, last = new[:-1], new[1:]
    runs = np.stack((first[new], end[last]), 1) - before[cuts[text[new]]][:, None]
    return inside & shared, runs, np.bincount(text[new], minlength=len(cuts) - 1)


def candidates(texts: DataFrame, least_line: int, least_words: int) -> DataFrame:
    """Different texts with long runs of shared lines: starts and hashes of these lines, places of the runs and of those
    in which earlier documents have all lines, and a byte per word."""
    parts = texts.select("rank", F.explode("lines").alias("line"))
    later = F.when(F.col("first") < F.col("rank"), F.col("line"))
    shared = parts.join(shared_lines(parts).hint("shuffle_hash"), "line").groupBy("rank").agg(F.collect_set("line").alias("shared"), F.collect_set(later).alias("later"))
    joined = texts.join(shared, "rank").dropDuplicates(["rank", "print"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, column="places"):
            count = batch.num_rows
            once, heads = flat(batch.column("lines"))
            if not len(once):
                continue
            known, number = np.unique(once, return_inverse=True)
            own = number * count + np.repeat(np.arange(count), np.diff(heads))
            # a line that is shared is so in every text that has it, but the first of these isn't later; texts of one id have their lists in common
            shared = np.isin(known, flat(batch.column("shared"))[0])[number]
            asked, cuts = flat(batch.column("later"))
            at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
            found = known[at] == asked
            later = np.isin(own, (at * count + np.repeat(np.arange(count), np.diff(cuts)))[found])

            places, cuts = flat(batch.column("places"))
            places, cuts = places.view(np.int32), cuts // 4
            sizes = flat(batch.column("sizes"))[0]
            text = np.repeat(np.arange(count), np.diff(cuts))
            long = places >= 0
            at = np.where(long, places + heads[text], 0)
            keep, runs, many = in_long_runs(shared[at] & long, sizes, cuts, least_line, least_words)
            _, runs_later, many_later = in_long_runs(later[at] & long, sizes, cuts, least_line, least_words)
            before = np.cumsum(sizes, dtype=np.int64) - sizes
            starts = (before - before[np.minimum(cuts, len(before) - 1)][text])[keep]
            kept = np.bincount(text[keep], minlength=count)
            rows = np.flatnonzero(kept)
            columns = [lists(starts.astype(np.int32), kept[rows]), lists(once[at[keep]], kept[rows])]
            columns += [lists(r.ravel().astype(np.int32), 2 * m[rows]) for r, m in ((runs, many), (runs_later, many_later))]
            taken = [batch.column(c).take(pa.array(rows)) for c in ("rank", "print", "marks")]
            yield pa.RecordBatch.from_arrays([*taken[:2], *columns, taken[2]], names=["rank", "print", "starts", "lines", "runs", "later", "marks"])

    return joined.mapInArrow(run, "rank bigint, print binary, starts array<int>, lines array<bigint>, runs array<int>, later array<int>, marks binary")


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs, sorted by their first members, in which the second ones increase."""
    if all(p[1] < q[1] for p, q in pairwise(pairs)):
        return pairs
    tops: list[int] = []
    ends: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        before[k] = ends[at - 1] if at else -1
        tops[at : at + 1] = [b]
        ends[at : at + 1] = [k]
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def patience(
    a: list[tuple[int, int]], b: list[tuple[int, int]], x: np.ndarray, y: np.ndarray, least: int = 1
) -> list[tuple[int, int, int]]:
    """Aligned blocks of two texts: first word in each, and the number of words.

    ``a`` and ``b`` list the start and hash of shared lines, in order, ``x`` and ``y`` hold a byte per word. Between two
    blocks the lines that are left are aligned anew; where none occurs once on both sides, equal occurrences are paired in order.
    Where fewer than ``least`` words are left on a side, no block of that size can be, and nothing is aligned.
    """
    out: list[tuple[int, int, int]] = []
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        left = a[bisect_left(a, (a0,)) : bisect_left(a, (a1,))]
        right = b[bisect_left(b, (b0,)) : bisect_left(b, (b1,))]
        if not left or not right:
            continue
        many_left, many_right = Counter(h for _, h in left), Counter(h for _, h in right)
        where = {h: s for s, h in right if many_right[h] == 1}
        anchors = [(s, where[h]) for s, h in left if many_left[h] == 1 and h in where]
        if not anchors:
            turn: Counter = Counter()
            places: dict[tuple[int, int], int] = {}
            for s, h in right:
                turn[h] += 1
                places[(h, turn[h])] = s
            turn.clear()
            for s, h in left:
                turn[h] += 1
                if (h, turn[h]) in places:
                    anchors.append((s, places[(h, turn[h])]))
        at_a, at_b = a0, b0
        blocks = []
        for s, t in increasing(anchors):
            if s < at_a or t < at_b:
                continue
            back = _agree(x[at_a:s][::-1], y[at_b:t][::-1])
            ahead = _agree(x[s:a1], y[t:b1])
            if ahead:
                blocks.append((s - back, t - back, back + ahead))
                at_a, at_b = s + ahead, t + ahead
        out += blocks
        if blocks:
            edges = [(a0, b0, 0), *blocks, (a1, b1, 0)]
            for (p, q, n), (r, s, _) in zip(edges[:-1], edges[1:], strict=True):
                if r - p - n >= least and s - q - n >= least:
                    todo.append((p + n, r, q + n, s))
    return sorted(out)


def common_blocks(
    a: list[tuple[int, int]], b: list[tuple[int, int]], x: np.ndarray, y: np.ndarray, least: int
) -> list[tuple[int, int]]:
    """Ranges of at least ``least`` words of the first text that the second one has.

    What an alignment leaves over is aligned once more, as long as that finds a block: passages may stand in
    another order, or twice. Lines that only one of them has make no difference.
    """
    out: list[tuple[int, int]] = []
    if a == b and np.array_equal(x, y):
        return [(0, len(x))] if a and len(x) >= least else out
    while a:
        found = [(s, s + n) for s, _, n in patience(a, b, x, y, least) if n >= least]
        if not found:
            break
        out += found
        a = [(s, h) for s, h in a if not any(start <= s < end for start, end in found)]
    return sorted(out)


def _agree(x: np.ndarray, y: np.ndarray) -> int:
    """Number of equal values at the beginning."""
    n = min(len(x), len(y))
    if not n:
        return 0
    different = x[:n] != y[:n]
    at = int(different.argmax())
    return at if different[at] else n


def windows(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of ``size`` words that begin at some places."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values.astype(np.uint64) + np.uint64(1)) * _power("up", len(values)), out=sums[1:])
    return mix((sums[at + size] - sums[at]) * _power("down", len(sums))[at]).view(np.int64)


def least_grams(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Of each window of ``size`` words the least hash of all runs of three quarters as many words inside.

    Equal windows have equal ones, and neighbouring windows mostly have the same.
    """
    length = size - size // 4
    least = windows(values, np.arange(len(values) - length + 1), length)
    reach, wanted = 1, size - length + 1  # the runs that least covers so far, and those in a window
    while reach < wanted:
        step = min(reach, wanted - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    return least[at]


def uncovered(count: int, start: np.ndarray, end: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Which windows have a word outside all spans, among ``count`` words."""
    steps = np.bincount(start, minlength=count + 1) - np.bincount(end, minlength=count + 1)
    bare = np.concatenate(([0], np.cumsum(np.cumsum(steps[:-1]) <= 0)))
    return bare[at + size] > bare[at]


def fewest(found: list[tuple[int, int]], size: int) -> list[tuple[int, int, int]]:
    """As few blocks as cover the same words: document and range, from windows (place, document) in order.

    Neighbouring windows of one document are a block; among blocks that overlap, those that reach farthest are kept.
    """
    runs: list[list[int]] = []
    open_: dict[int, list[int]] = {}
    for at, first in found:
        if first in open_ and open_[first][2] == at + size - 1:
            open_[first][2] = at + size
        else:
            open_[first] = [first, at, at + size]
            runs.append(open_[first])
    return cover(runs)


def cover(runs: list[list[int]]) -> list[tuple[int, int, int]]:
    """As few of some blocks (document, start, end), in order of their starts, as cover the same words."""
    out: list[tuple[int, int, int]] = []
    k, reached = 0, -1
    while k < len(runs):
        best = None
        while k < len(runs) and runs[k][1] <= reached:
            best = max(best or runs[k], runs[k], key=lambda x: x[2])
            k += 1
        if best and best[2] > reached:
            out.append(tuple(best))
            reached = best[2]
        elif k < len(runs):
            reached = runs[k][1]
    return out


def by_windows(plain: DataFrame, left: DataFrame, blocks: DataFrame, size: int) -> DataFrame:
    """Blocks of later texts that ``blocks`` leave over, from all windows of ``size`` words.

    A window that isn't covered is linked to the first document that has it, covered there or not. The bytes of
    the words choose windows that several documents seem to have; the words of ``plain`` decide. A bit table
    of fixed size drops windows that nobody asks for before anything is shuffled; it never drops others. Of the rest
    those are chosen whose least run of words (``least_grams``) several documents have: one row for many windows.
    """
    spans = blocks.groupBy("rank", "print").agg(F.collect_set(F.struct("start", "end")).alias("spans"))

    def found(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first word and text of every window in the runs of all texts, and where the words of each text begin."""
        marks, cuts = flat(batch.column("marks"))
        runs, heads = flat(batch.column(column))
        a, b = runs.reshape(-1, 2).astype(np.int64).T
        many = np.maximum(b - a - size + 1, 0)
        text = np.repeat(np.repeat(np.arange(batch.num_rows), np.diff(heads) // 2), many)
        at = np.arange(len(text)) + np.repeat(a - np.cumsum(many) + many, many) + cuts[text]
        return windows(marks, at, size), at, text, cuts

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, AT_ONCE, "marks"):
            hashes, at, _, cuts = found(batch, "later")
            spans = batch.column("spans")
            own = np.repeat(cuts[:-1], spans.value_lengths().fill_null(0).to_numpy())
            start, end = (spans.flatten().field(c).to_numpy() + own for c in ("start", "end"))
            wanted = np.unique(hashes[uncovered(int(cuts[-1]), start, end, at, size)])
            yield pa.RecordBatch.from_arrays([pa.array(wanted)], names=["hash"])

    # The first document with a line asks for none of its windows, or all copies would answer.
    later = left.filter(F.size("later") > 0).select("rank", "print", "later", "marks")
    asked = later.join(spans, ["rank", "print"], "left").mapInArrow(ask, "hash bigint")
    shared = left.sparkSession.sparkContext.broadcast(np.packbits(bit_table(asked)))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value

        def has(at: np.ndarray) -> np.ndarray:
            at = at.astype(np.int64)
            return (known[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)

        for batch in pieces(batches, AT_ONCE, "marks"):
            hashes, at, text, cuts = found(batch, "runs")
            one, two = _probes(hashes.view(np.uint64))
            hit = np.flatnonzero(has(one))
            hit = hit[has(two[hit])]
            if len(hit):
                at, text = at[hit], text[hit]
                count = np.bincount(text, minlength=batch.num_rows)
                heads = np.concatenate(([0], np.cumsum(count)))
                grams, many, places = each_once(least_grams(flat(batch.column("marks"))[0], at, size), np.ones(len(at), bool), heads)
                own = [batch.column(c) for c in ("rank", "print")]
                columns = [lists(grams, many), binaries(places, heads), binaries((at - cuts[text]).astype(np.int32), heads)]
                rows = pa.RecordBatch.from_arrays([*own, *columns], names=["rank", "print", "grams", "places", "at"])
                yield rows.filter(pa.array(count > 0))

    answers = written(left.select("rank", "print", "runs", "marks").mapInArrow(answer, "rank bigint, print binary, grams array<bigint>, places binary, at binary"))
    parts = answers.select("rank", F.explode("grams").alias("line"))
    alike = parts.join(shared_lines(parts).hint("shuffle_hash"), "line").groupBy("rank").agg(F.collect_set("line").alias("alike"))
    chosen = written(answers.join(alike, "rank"))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            spelled = words(encoded(batch.column("text")))
            grams, heads = flat(batch.column("grams"))
            places, cuts = flat(batch.column("places"))
            text = np.repeat(np.arange(batch.num_rows), np.diff(cuts) // 4)
            # a run of words that several documents have is so in all texts of the batch
            known = np.isin(grams, flat(batch.column("alike"))[0])[places.view(np.int32) + heads[text]]
            at, text = flat(batch.column("at"))[0].view(np.int32)[known], text[known]
            hashes = windows(spelled.hash, at + spelled.first[text], size)
            own = [batch.column(c).take(pa.array(text)) for c in ("rank", "print")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(hashes), pa.array(at)], names=["rank", "print", "hash", "at"])

    copies = plain.join(chosen, ["rank", "print"])
    exact = written(copies.mapInArrow(spell, "rank bigint, print binary, hash bigint, at int"))
    holders = exact.groupBy("hash").agg(F.min("rank").alias("first"), F.max("rank").alias("last")).filter("first < last").drop("last")
    found_at = F.collect_set(F.struct("at", "first")).alias("found")
    hits = exact.join(holders.hint("shuffle_hash"), "hash").filter("first < rank").groupBy("rank", "print").agg(found_at)

    def merge(own: pa.Array) -> list[tuple[int, int, int]]:
        at, first = (own.field(c).to_numpy() for c in ("at", "first"))
        order = np.lexsort((first, at))
        return fewest(list(zip(at[order].tolist(), first[order].tolist(), strict=True)), size)

    return per_text(hits, "found", merge)


def per_text(grouped: DataFrame, column: str, blocks_of) -> DataFrame:
    """Blocks (document, start, end) that a function makes of a list of structs, one text at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for k in range(batch.num_rows):
                out += [(k, *block) for block in blocks_of(batch.column(column)[k].values)]
            rows = pa.array([o[0] for o in out], pa.int64())
            own = [pa.array([o[n] for o in out], pa.int64()) for n in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(rows) for c in ("rank", "print")], *own], names=["rank", "print", "first", "start", "end"])

    return grouped.mapInArrow(run, BLOCKS)


def covering(blocks: DataFrame) -> DataFrame:
    """Of the blocks of each text as few as cover the same words."""

    def chosen(own: pa.Array) -> list[tuple[int, int, int]]:
        first, start, end = (own.field(c).to_numpy() for c in ("first", "start", "end"))
        order = np.lexsort((first, -end, start))
        return cover([list(b) for b in zip(first[order].tolist(), start[order].tolist(), end[order].tolist(), strict=True)])

    spans = F.collect_set(F.struct("first", "start", "end")).alias("spans")
    return per_text(blocks.groupBy("rank", "print").agg(spans), "spans", chosen)


def rank_of(doc_id: Column, text: Column) -> Column:
    """Place of a document in the order: its id, and without an id a place behind all ids that its text decides."""
    return F.coalesce(doc_id.try_cast("long"), F.lit(LAST) - F.pmod(F.xxhash64(text), F.lit(LAST - NO_ID)))


def aligned(docs: DataFrame, doc_id: str = "doc_id", least_words: int = BLOCK_WORDS) -> DataFrame:
    """Blocks to delete: ``rank`` (the id), ``print`` of the later text, ``first``, the rank of the
    earlier document, ``start`` and ``end`` (words of the later text).

    Documents are ordered by id; those without one, or with one that is no number, come last in an order that their texts
    decide, with ranks above ``NO_ID``. Rows with the same id aren't compared with each other. Words are runs of
    other bytes than ASCII blanks. Null and empty texts have no block. Of the blocks of a text only as many are returned as
    cover their words; these may still overlap. Repeated rows are one document. Very long texts are read whole; an empty table has no blocks.
    """
    rank = rank_of(F.col(doc_id), F.col("text"))
    plain = docs.select(rank.alias("rank"), fingerprint("text").alias("print"), "text").filter("print is not null")
    texts = written(sequences(plain, LINE_WORDS))
    left = written(candidates(texts, LINE_WORDS, least_words))
    parts = left.select("rank", F.explode(F.array_distinct("lines")).alias("line"))
    pairs = parts.join(shared_lines(parts).hint("shuffle_hash"), "line").filter("first < rank").select("rank", "first").distinct()
    later = pairs.join(left, "rank")
    earlier = left.select(F.col("rank").alias("first"), *[F.col(c).alias(f"other_{c}") for c in ("starts", "lines", "marks")])
    both = later.join(earlier, "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, column="marks"):
            sides = [[flat(batch.column(prefix + c)) for c in ("starts", "lines", "marks")] for prefix in ("", "other_")]
            texts = [np.repeat(np.arange(batch.num_rows), np.diff(cuts)) for _, (_, cuts), _ in sides]
            number = np.unique(np.concatenate([lines for _, (lines, _), _ in sides]), return_inverse=True)[1]
            numbers = np.split(number, [len(texts[0])])
            own = [n * batch.num_rows + text for n, text in zip(numbers, texts, strict=True)]
            rows = []
            for (starts, _), n, text, in_both in zip([side[0] for side in sides], numbers, texts, (np.isin(*own), np.isin(*own[::-1])), strict=True):
                found = list(zip(starts[in_both].tolist(), n[in_both].tolist(), strict=True))
                ends = np.cumsum(np.bincount(text[in_both], minlength=batch.num_rows)).tolist()
                rows.append([found[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)])
            marks = [[values[i:j] for i, j in pairwise(cuts.tolist())] for _, _, (values, cuts) in sides]
            out: list[tuple[int, int, int]] = []
            for k, (a, b, x, y) in enumerate(zip(*rows, *marks, strict=True)):
                out += [(k, start, end) for start, end in common_blocks(a, b, x, y, least_words)]
            at = pa.array([o[0] for o in out], pa.int64())
            spans = [pa.array([o[n] for o in out], pa.int64()) for n in (1, 2)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(at) for c in ("rank", "print", "first")], *spans], names=["rank", "print", "first", "start", "end"])

    blocks = written(both.mapInArrow(run, BLOCKS))
    return covering(blocks.unionByName(by_windows(plain, left, blocks, least_words)))


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without some ranges of words and the blanks after them."""
    starts = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, at = [], 0
    for start, end in sorted(spans):
        out.append(text[at : max(at, starts[start])])
        at = max(at, starts[min(end, len(starts) - 1)])
    return "".join([*out, text[at:]])


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", least_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents with aligned blocks deleted from the later ones; all columns stay.

    A document that had words and has none left is dropped: all it says is in earlier ones. Texts
    without a block, nulls among them, come back unchanged.
    """
    blocks = aligned(docs, doc_id, least_words).groupBy("rank", "print").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    rank, mark, spans = fresh(docs, "rank", "mark", "spans")
    blocks = blocks.withColumnsRenamed({"rank": rank, "print": mark, "spans": spans})
    same: Column = (rank_of(docs[doc_id], docs["text"]) == blocks[rank]) & (fingerprint(docs["text"]) == blocks[mark])
    joined = docs.join(blocks, same, "left").drop(rank, mark)
    names = docs.columns
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = batch.column(len(names)).to_pylist()
            texts = batch.column(place).to_pylist()
            left = [t if s is None else cut(t, [(x["start"], x["end"]) for x in s]) for t, s in zip(texts, found, strict=True)]
            keep = pa.array([s is None or bool(_WORD.search(t)) for t, s in zip(left, found, strict=True)])
            columns = [*batch.columns[:place], pa.array(left, pa.string()), *batch.columns[place + 1 : -1]]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(keep)

    return joined.mapInArrow(run, docs.schema)
