"""An interpolated modified Kneser-Ney model of any order, in sorted hash arrays that workers map.

Counting is one Spark job for words and one for n-grams. The second counts the n-grams of the highest order; the task that
owns an n-gram then says to the owners of its beginning and of its end (one word less) what it adds to them, and so on down to
single words. Tasks add up what they have before anything is shuffled, and n-grams are dealt by a hash of all their words, so
a frequent word or context is no hot key: what is said about it are sums.

Every part is written as flat arrays to the shared folder. Parts are ranges of a 64-bit hash and hold about two million tokens'
worth, so their number follows the corpus. In a part, buckets of about sixteen n-grams are found by the upper bits; of the
others 32 are stored in order. So in about 300 million n-grams that were never seen one is taken for another. Next to
a key stands the number of its counts in the list of all that occur in the part. Scoring tasks map the files; of a model larger than memory
the operating system holds the pages in use. The shared folder must therefore be mounted on all machines (``file:`` or a plain path).

The model. With a the count of an n-gram (at the highest order how often it occurs, below how many different words come before
it), S the sum of the counts after its context, D the discounts of the order for counts 1, 2, 3 and more, N1, N2, N3 how many n-grams
with the context have such counts: ``P(w|u) = max(a - D(a), 0) / S(u) + (D1 N1(u) + D2 N2(u) + D3 N3(u)) / S(u) * P(w|u')``, where
u' is u without its first word, ending in 1 / (V + 1) for every word known or not. Before a text stand as many marks as a
context has words, which are never predicted; after it stands one that is.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import new_folder
from forecourt.llm.tokens import LOWER, combine, encoded, mix, pieces, words

# Hash of the mark after a text. No text has a blank inside a word, so no word is spelled like it.
END = int(mix(np.array([0xE], np.uint64))[0])
UNKNOWN, START = 0xFFFFFFFF, 0xFFFFFFFE  # not the number of any word
GATHER = 1 << 22  # tokens that a task adds up before it hands them on
PART_BYTES = 1 << 24  # of text for each part of the n-grams
BUCKET = 16
SCORED_BYTES = 1 << 22  # of text scored at once; every part is opened once for them

_U = np.uint64


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each text with its end mark, and where the texts begin; one more entry at the end."""
    found = words(texts, LOWER)
    starts = found.first + np.arange(len(found.first))
    out = np.empty(len(found.hash) + len(texts), np.uint64)
    ends = starts[1:] - 1
    out[ends] = END
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = found.hash
    return out, starts


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order with the sums of their counts (one column of counts or several)."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
    return keys[starts], np.add.reduceat(counts, starts, axis=0) if len(keys) else counts


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` equal ranges of hashes a key falls in."""
    return (((keys >> _U(32)) * _U(parts)) >> _U(32)).astype(np.int32)


def _local(folder: str) -> str:
    path = folder.removeprefix("file://")
    if "://" in path or not path.startswith("/"):
        raise ValueError(f"the model's arrays are memory-mapped, so {folder} must be a mounted folder")
    return path


def _write(folder: str, part: int, **arrays: np.ndarray) -> None:
    """Arrays of one part. A repeated task writes the same again; a file appears whole or not at all."""
    os.makedirs(folder, exist_ok=True)
    for name, array in arrays.items():
        draft = f"{folder}/.{uuid.uuid4().hex}"
        with open(draft, "wb") as file:
            np.save(file, array)
        os.replace(draft, f"{folder}/{name}-{part}.npy")


@lru_cache(maxsize=8192)
def _mapped(folder: str, name: str, part: int) -> np.ndarray | None:
    path = f"{folder}/{name}-{part}.npy"
    return np.load(path, mmap_mode="r") if os.path.exists(path) else None


def _look_up(folder: str, parts: int, keys: np.ndarray, *names: str) -> list[np.ndarray]:
    """For sorted different keys: their values in other arrays, -1 for those that aren't there."""
    out = [np.full(len(keys), -1, np.int64) for _ in names]
    cuts = np.searchsorted(_part_of(keys, parts), np.arange(parts + 1))
    for part in np.flatnonzero(np.diff(cuts)).tolist():
        a, b = cuts[part], cuts[part + 1]
        known = _mapped(folder, "key", part)
        if known is None or not len(known):
            continue
        at = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
        hit = np.flatnonzero(known[at] == keys[a:b])
        for values, name in zip(out, names, strict=True):
            values[a + hit] = _mapped(folder, name, part)[at[hit]]
    return out


def _gathered(batches: Iterator[pa.RecordBatch], count) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and counts of many batches together, whenever about ``GATHER`` of them have come up."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in pieces(batches):
        keys, counts = np.unique(count(encoded(batch.column("text"))), return_counts=True)
        held.append((keys, counts))
        size += len(keys)
        if size >= GATHER:
            yield _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _parcels(parts: np.ndarray, keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted keys and their counts as one row per part: a row for each key would cost Spark far more."""
    cuts = np.flatnonzero(np.concatenate((np.ones(min(len(parts), 1), bool), parts[1:] != parts[:-1]))).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(parts)], strict=True):
        row = [pa.array([int(parts[a])], pa.int32()), *[pa.array([x[a:b].tobytes()], pa.binary()) for x in (keys, values)]]
        yield pa.RecordBatch.from_arrays(row, names=["part", "keys", "counts"])


def _counted(texts: DataFrame, parts: int, count) -> DataFrame:
    """Keys and counts, dealt by part: each key once per gathering."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in _gathered(batches, count):
            yield from _parcels(_part_of(keys, parts), keys.astype("<u8"), counts.astype("<u4"))

    return texts.mapInArrow(run, "part int, keys binary, counts binary").repartitionById(parts, "part")


def _by_part(batches: Iterator[pa.RecordBatch], key_type: str, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """All keys of each part in a task, with ``width`` counts each, added up. Almost every task has one part."""
    held: dict[int, list] = {}
    for batch in batches:
        for part, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "keys", "counts")), strict=True):
            values = np.frombuffer(counts, "<u4").reshape(-1, width).astype(np.int64)
            held.setdefault(part, []).append((np.frombuffer(keys, key_type).astype(np.uint64), values))
    for part, rows in held.items():
        yield part, *_summed(*(np.concatenate(x) for x in zip(*rows, strict=True)))


def _sizes(counts: np.ndarray) -> list[int]:
    """How many keys have the counts 1, 2, 3 and 4."""
    return [int((counts == k).sum()) for k in range(1, 5)]


def discounts(sizes: list[int]) -> np.ndarray:
    """Discounts for counts 1, 2, 3 and more, from how many keys have the counts 1 to 4.

    Where a size is 0, as in tiny corpora, the usual formula has no value and half the count is taken.
    """
    n1, n2, n3, n4 = sizes
    out = np.array([0.5, 1.0, 1.5])
    if n1 and n2:
        y = n1 / (n1 + 2 * n2)
        out[0] = 1 - 2 * y * n2 / n1
        if n3:
            out[1] = 2 - 3 * y * n3 / n2
            if n4:
                out[2] = 3 - 4 * y * n4 / n3
    return np.clip(out, 0.0, [1.0, 2.0, 3.0])


@dataclass
class Model:
    """Where the arrays are, and the few numbers that hold for the whole corpus."""

    folder: str
    order: int
    word_parts: int
    parts: int
    tokens: int  # with end marks
    vocabulary: int
    sizes: list[list[int]]  # by order: n-grams with counts 1, 2, 3, 4, with 3 and more, sum of counts

    @property
    def base_denominator(self) -> int:
        return self.tokens + self.vocabulary + 1


def _packed(rows: np.ndarray) -> bytes:
    """Whole numbers in few bytes: no wider than the largest, differences in the first column, bytes of equal weight together."""
    import zstandard

    kind = np.min_scalar_type(int(rows.max(initial=0))).newbyteorder("<")
    rows = np.array(rows, kind, order="C")
    rows[1:, 0] -= rows[:-1, 0].copy()
    planes = np.ascontiguousarray(rows.view(np.uint8).reshape(len(rows), -1).T)
    return bytes([kind.itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes)


def _unpacked(data: bytes, kind: type, width: int) -> np.ndarray:
    import zstandard

    stored = np.dtype(f"<u{data[0]}")
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(memoryview(data)[1:]), np.uint8)
    rows = np.array(planes.reshape(stored.itemsize * width, -1).T, order="C").view(stored).reshape(-1, width)
    rows[:, 0] = np.cumsum(rows[:, 0], dtype=rows.dtype)
    return rows.astype(kind)


def _merged(grams: np.ndarray, values: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams (rows of word numbers) side by side by first words, with the sums of their values (one each by default)."""
    order = _order(grams)
    grams = grams[order]
    starts = _starts(grams)
    if values is None:
        return grams[starts], np.diff(np.append(starts, len(grams)))[:, None]
    return grams[starts], _sums(values[order], starts)


def _order(grams: np.ndarray) -> np.ndarray:
    """An order in which equal n-grams lie together: by one number of 64 bits, with some bits of every word's number.

    Frequent words have small numbers, so few n-grams share that number; those that do are ordered by all their words.
    """
    width = grams.shape[1]
    bits = 64 // width
    first = 64 - bits * (width - 1)
    key = grams[:, 0].astype(np.uint64) & _U((1 << first) - 1)
    for k in range(1, width):
        key = (key << _U(bits)) | (grams[:, k].astype(np.uint64) & _U((1 << bits) - 1))
    order = np.argsort(key)
    if bits >= 32:
        return order
    key, sorted_ = key[order], grams[order]
    same = key[1:] == key[:-1]
    mixed = same & (sorted_[1:] != sorted_[:-1]).any(1)
    if mixed.any():
        rows = np.flatnonzero(np.isin(key, key[1:][mixed]))
        order[rows] = order[rows][np.lexsort([*sorted_[rows].T[::-1], key[rows]])]
    return order


def _starts(grams: np.ndarray) -> np.ndarray:
    """Where, in rows that lie together, another n-gram begins."""
    new = np.zeros(len(grams), bool)
    new[:1] = True
    for column in grams.T:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0) if len(starts) else values


def _longer(prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of an n-gram, from that of its beginning and its last word's number."""
    return mix(prefix * _U(0x9E3779B97F4A7C15) + last.astype(np.uint64) + _U(1))


def _hashes(grams: np.ndarray) -> np.ndarray:
    out = np.zeros(len(grams), np.uint64)
    for k in range(grams.shape[1]):
        out = _longer(out, grams[:, k])
    return out


def _dealt(grams: np.ndarray, values: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """N-grams and their values as one row for each part."""
    owner = _part_of(_hashes(grams), parts).astype(np.min_scalar_type(max(parts - 1, 0)))
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(parts + 1))
    for part in np.flatnonzero(np.diff(cuts)).tolist():
        own = order[cuts[part] : cuts[part + 1]]
        row = [pa.array([part], pa.int32()), pa.array([_packed(grams[own])]), pa.array([_packed(values[own])])]
        yield pa.RecordBatch.from_arrays([*row, pa.array([None], pa.list_(pa.int64()))], names=["part", "grams", "counts", "sizes"])


def _write_grams(folder: str, parts: int, part: int, grams: np.ndarray, values: np.ndarray) -> None:
    keys = _hashes(grams)
    many = max(1, len(keys) // BUCKET)
    bucket = _bucket_of(keys, parts, many).astype(np.uint64)
    place = (bucket << _U(32)) | keys.astype(np.uint32)
    order = np.argsort(place)
    place, whole = place[order], np.ascontiguousarray(values[order])
    kinds, code = np.unique(combine(list(whole.T.astype(np.uint64))), return_inverse=True)
    first = np.zeros(len(kinds), np.int64)
    first[code] = np.arange(len(code))
    small = np.min_scalar_type(max(len(first) - 1, 0))
    edges = np.searchsorted(place >> _U(32), np.arange(many + 1, dtype=np.uint64)).astype(np.uint32)
    _write(folder, part, low=place.astype(np.uint32), bucket=edges, code=code.astype(small), value=whole[first])


def _bucket_of(keys: np.ndarray, parts: int, many: int) -> np.ndarray:
    """Which of ``many`` equal ranges of its part a key falls in."""
    inside = ((keys >> _U(32)) * _U(parts)) & _U(0xFFFFFFFF)
    return ((inside * _U(many)) >> _U(32)).astype(np.int64)


def _counts_of(folder: str, parts: int, keys: np.ndarray, width: int) -> np.ndarray:
    """The values of n-grams given by their hashes; zeros for those that aren't there."""
    unique, back = np.unique(keys, return_inverse=True)
    out = np.zeros((len(unique), width))
    cuts = np.searchsorted(_part_of(unique, parts), np.arange(parts + 1))
    for part in np.flatnonzero(np.diff(cuts)).tolist():
        low = _mapped(folder, "low", part)
        if low is None or not len(low):
            continue
        own = unique[cuts[part] : cuts[part + 1]]
        edges = _mapped(folder, "bucket", part)
        bucket = _bucket_of(own, parts, len(edges) - 1)
        a, end = edges[bucket].astype(np.int64), edges[bucket + 1].astype(np.int64)
        b, wanted = end.copy(), own.astype(np.uint32)
        while (a < b).any():
            middle = (a + b) // 2
            less = (a < b) & (low[np.minimum(middle, len(low) - 1)] < wanted)
            a, b = np.where(less, middle + 1, a), np.where(less, b, np.minimum(b, np.maximum(middle, a)))
        hit = np.flatnonzero((a < end) & (low[np.minimum(a, len(low) - 1)] == wanted))
        out[cuts[part] + hit] = _mapped(folder, "value", part)[_mapped(folder, "code", part)[a[hit]]]
    return out[back]


def _numbers(folder: str, parts: int, order: int, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all texts behind their start marks, which of them are tokens, and the token hashes: different ones and places."""
    found, starts = tokens(texts)
    unique, back = np.unique(found, return_inverse=True)
    place = _look_up(f"{folder}/words", parts, unique, "number")[0]
    own = np.where(place < 0, UNKNOWN, place).astype(np.uint32)[back]
    at = np.arange(len(own)) + (order - 1) * np.repeat(np.arange(1, len(texts) + 1), np.diff(starts))
    out = np.full(len(own) + (order - 1) * len(texts), START, np.uint32)
    out[at] = own
    return out, at, unique, back


def _below(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What n-grams say about those of one word less: how many end with them, the sum of the counts of those that
    begin with them, and how many of these have counts 1, 2, 3 and more."""
    ends, many = _merged(grams[:, 1:])
    # equal beginnings lie together, but for a few; those are sums too and the owner adds them up
    starts = _starts(grams[:, :-1])
    kinds = _sums(np.column_stack([counts, counts == 1, counts == 2, counts > 2]).astype(np.int64), starts)
    values = np.zeros((len(ends) + len(starts), 5), np.int64)
    values[: len(ends), :1] = many
    values[len(ends) :, 1:] = kinds
    return np.concatenate([ends, grams[starts, :-1]]), values


def _level(folder: str, order: int, size: int, parts: int):
    """The work of the tasks that own the n-grams of one size: add up, write, tell the next size."""
    top = size == order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros((order, 6), np.int64)
        held: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["sizes"]:
                    sizes += np.array(row["sizes"], np.int64).reshape(order, 6)
                if row["grams"] is not None:
                    values = _unpacked(row["counts"], np.int64, 1 if top else 5)
                    held.setdefault(row["part"], []).append((_unpacked(row["grams"], np.uint32, size), values))
        for part, rows in held.items():
            grams, values = _merged(*(np.concatenate(x) for x in zip(*rows, strict=True)))
            _write_grams(f"{folder}/{size}", parts, part, grams, values)
            counted = values[:, 0] > 0
            grams, counts = grams[counted], values[counted, 0]
            sizes[size - 1] += [*_sizes(counts), int((counts > 2).sum()), int(counts.sum())]
            if size > 1:
                yield from _dealt(*_below(grams, counts), parts)
        last = [pa.array([0], pa.int32()), pa.array([None], pa.binary()), pa.array([None], pa.binary())]
        yield pa.RecordBatch.from_arrays([*last, pa.array([sizes.ravel().tolist()], pa.list_(pa.int64()))], names=["part", "grams", "counts", "sizes"])

    return run


def train(docs: DataFrame, folder: str | None = None, parts: int | None = None, order: int = 3) -> Model:
    """Count the column ``text`` of all rows and write the arrays below ``folder`` (the shared one by default).

    Null and empty texts are a lone end mark. Repeated rows count as often as they occur. A table without
    rows gives a model without words, under which every token is unknown. ``parts`` says how many files hold each array;
    by default one for every 16 MB of text, and at least as many as there are shuffle partitions. ``order`` is the
    length of the longest n-grams, 2 at least.
    """
    if order < 2:
        raise ValueError("the order is 2 at least")
    spark = docs.sparkSession
    folder = _local(folder or new_folder(spark))
    texts = docs.select("text")
    if parts is None:
        volume = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-volume // PART_BYTES))

    def write_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for part, keys, counts in _by_part(batches, "<u8", 1):
            counts = counts[:, 0]
            # frequent words have small numbers, which take few bytes when n-grams are dealt
            rank = np.empty(len(keys), np.int64)
            rank[np.argsort(-counts, kind="stable")] = np.arange(len(keys))
            number = rank * parts + part
            _write(f"{folder}/words", part, key=keys, n=counts.astype(np.min_scalar_type(counts.max(initial=0))), number=number.astype(np.uint32))
            out.append((len(keys), int(counts.sum()), int(number.max(initial=0))))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], names=["keys", "n", "last"])

    def all_tokens(batch: list[bytes]) -> np.ndarray:
        return tokens(batch)[0]

    counted = _counted(texts, parts, all_tokens).mapInArrow(write_words, "keys bigint, n bigint, last bigint").collect()
    vocabulary, total = (sum(r[c] for r in counted) for c in ("keys", "n"))
    if max((r["last"] for r in counted), default=0) >= START:
        raise ValueError("more words than 32 bits can number")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in pieces(batches):
            words_, at, _, _ = _numbers(folder, parts, order, encoded(batch.column("text")))
            held.append(np.column_stack([words_[at - k] for k in range(order - 1, -1, -1)]))
            if sum(map(len, held)) >= GATHER:
                grams = np.concatenate(held)
                yield from _dealt(*_merged(grams), parts)
                held = []
        if held:
            grams = np.concatenate(held)
            yield from _dealt(*_merged(grams), parts)

    shape = "part int, grams binary, counts binary, sizes array<bigint>"
    rows = texts.mapInArrow(read, shape)
    for size in range(order, 0, -1):
        rows = rows.repartitionById(parts, "part").mapInArrow(_level(folder, order, size, parts), shape)
    found = [r["sizes"] for r in rows.select("sizes").collect() if r["sizes"]]
    sizes = np.array(found, np.int64).reshape(-1, order, 6).sum(0).tolist()
    return Model(folder, order, parts, parts, total, vocabulary, sizes)


def unmix(x: np.ndarray) -> np.ndarray:
    """What ``mix`` was given: two different words or n-grams can't become equal by mixing."""

    def unshift(v: np.ndarray, n: int) -> np.ndarray:
        out = v
        for _ in range(64 // n + 1):
            out = v ^ (out >> _U(n))
        return out

    x = unshift(x.astype(np.uint64), 31) * _U(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = unshift(x, 27) * _U(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return unshift(x, 30)


def _discounted(counts: np.ndarray, discount: np.ndarray) -> np.ndarray:
    cut = np.concatenate(([0.0], discount))[np.minimum(counts, 3).astype(np.int64)]
    return np.maximum(counts - cut, 0)


def score_texts(model: Model, texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """For each text: tokens, tokens seen in training, base log10 probability, the model's log10 probability."""
    number, at, unique, back = _numbers(model.folder, model.word_parts, model.order, texts)
    count = np.maximum(_look_up(f"{model.folder}/words", model.word_parts, unique, "n")[0], 0)[back]
    ones, twos, _, _, more, total = model.sizes[0]
    hashes = _longer(np.zeros(len(number), np.uint64), number)
    values = _counts_of(f"{model.folder}/1", model.parts, hashes, 5)
    discount = discounts(model.sizes[0][:4])
    rest = (discount @ [ones, twos, more]) / total if total else 1.0
    chance = _discounted(values[at, 0], discount) / max(total, 1) + rest / (model.vocabulary + 1)
    for size in range(2, model.order + 1):
        after = values[at - 1, 1:]
        hashes = _longer(np.concatenate((hashes[:1], hashes[:-1])), number)
        values = _counts_of(f"{model.folder}/{size}", model.parts, hashes, 1 if size == model.order else 5)
        discount = discounts(model.sizes[size - 1][:4])
        known = np.maximum(after[:, 0], 1)
        share = np.where(after[:, 0] > 0, (after[:, 1:] @ discount) / known, 1.0)
        chance = np.where(after[:, 0] > 0, _discounted(values[at, 0], discount) / known, 0.0) + share * chance
    # the first token of each text follows a start mark
    starting = np.flatnonzero(number[at - 1] == START)
    base = np.log10((count + 1) / model.base_denominator)
    sums = [np.add.reduceat(v, starting) for v in ((count > 0).astype(np.int64), base, np.log10(chance))]
    return np.diff(np.append(starting, len(at))), *sums


def score(df: DataFrame, model: Model) -> DataFrame:
    """Replace ``text`` by ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``perplexity``.

    Null texts count as empty: one token, the end mark. All other columns stay, except those of these
    names. Long texts are scored whole.
    """
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    kept = [c for c in df.columns if c not in (*names, "text")]
    shape = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double"
    schema = ", ".join([df.select(*kept)._jdf.schema().toDDL()] * bool(kept) + [shape])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, SCORED_BYTES):
            n, known, base, own = score_texts(model, encoded(batch.column("text")))
            found = [n, known, np.full(len(n), model.tokens), base, own, 10 ** (-own / n)]
            kinds = [pa.int64()] * 3 + [pa.float64()] * 3
            added = [pa.array(v, t) for v, t in zip(found, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *added], names=[*kept, *names])

    return df.select(*kept, "text").mapInArrow(run, schema)
