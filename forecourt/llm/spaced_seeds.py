"""Benchmark decontamination with spaced seeds.

A mask names the words of a short window that count; the others may differ. Hashes of the named
words of every window are joined between benchmark and training texts. A hit says which stretch of
a document lies opposite which item; there the words are compared one by one, and an overlap is
the union of all runs that are long enough and have four of five words equal.

Only documents with a hit leave the scan. A bit table of the benchmark's hashes, of fixed size, drops
windows that can't be hits before anything is shuffled; it never drops a hit. What is kept of a
document are the hashes of the words around its hits, as far as the longest item reaches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import fingerprint, fresh, written
from forecourt.llm.tokens import ALNUM, Words, encoded, mix, packed, pieces, unpacked, words

# The masks; a 1 is a word that must agree.
MASKS = ("111111", "11011011", "1100111001", "1010110101")
BITS = 25  # size of the bit table, 4 MB
LEAST_WORDS = 8  # an item with fewer words says too little to be found
MATCH, MISMATCH = 1, 4  # four of five words must agree


def _seeds(found: Words, offsets: list[int], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words at some offsets of every window inside a text, and where windows begin."""
    last = len(found.hash) - offsets[-1]
    if last <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(found.text[:last] == found.text[offsets[-1] :])
    total = np.full(len(at), seed + 1, np.uint64)
    for k, offset in enumerate(offsets):
        total += found.hash[at + offset] * np.uint64(0xD6E8FEB86659FD93 + 2 * k * k + 4 * k)
        total ^= total >> np.uint64(29)
    return mix(total), at


def all_seeds(found: Words, masks: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every seed of every mask."""
    parts = [_seeds(found, [k for k, c in enumerate(mask) if c == "1"], n) for n, mask in enumerate(masks)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _probes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64), (hashes & np.uint64((1 << BITS) - 1)).astype(np.int64)


def benchmark_seeds(items: DataFrame, masks: tuple[str, ...], least: int) -> tuple[DataFrame, DataFrame]:
    """Tables of the items: their word hashes, and their seeds with places."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = words(encoded(batch.column("text")), ALNUM)
            hashes, at = all_seeds(found, masks)
            order = np.argsort(found.text[at], kind="stable")
            cuts = np.searchsorted(found.text[at][order], np.arange(batch.num_rows + 1))
            first = found.first
            rows = []
            for k in range(batch.num_rows):
                own = order[cuts[k] : cuts[k + 1]]
                rows.append((packed(found.hash[first[k] : first[k + 1]]), hashes[own].view(np.int64).tolist(), (at[own] - first[k]).tolist()))
            columns = [pa.array([r[n] for r in rows], t) for n, t in enumerate((pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())))]
            yield pa.RecordBatch.from_arrays([batch.column("item"), *columns], names=["item", "words", "hashes", "places"])

    kind = dict(items.dtypes)["item"]
    found = written(items.mapInArrow(read, f"item {kind}, words binary, hashes array<bigint>, places array<int>"))
    long = found.filter(F.length("words") >= 8 * least)
    pairs = long.select("item", F.explode(F.arrays_zip("hashes", "places")).alias("p"))
    return long.select("item", "words"), pairs.select("item", F.col("p.hashes").alias("hash"), F.col("p.places").alias("place"))


def bit_table(seeds: DataFrame) -> np.ndarray:
    """Two bits per hash in a table of fixed size: at most ``2**BITS / 32`` rows reach the driver."""
    first = F.shiftrightunsigned("hash", 64 - BITS)
    second = F.col("hash").bitwiseAND((1 << BITS) - 1)
    bits = seeds.select(F.explode(F.array(first, second)).alias("bit"))
    cells = bits.groupBy(F.shiftright("bit", 5).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("mask")
    )
    table = np.zeros(1 << BITS, bool)
    rows = cells.toArrow()
    cell, mask = rows.column("cell").to_numpy(), rows.column("mask").to_numpy()
    for k in range(32):
        table[cell[(mask >> k) & 1 == 1] * 32 + k] = True
    return table


def stretches(docs: DataFrame, table: np.ndarray, masks: tuple[str, ...], reach: int) -> DataFrame:
    """Parts of documents around possible hits: key, first word, word hashes, and the seeds with places.

    Hits less than ``reach`` words apart share a stretch, which goes on for ``reach`` words on both sides.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(np.packbits(table))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(shared.value).view(bool)
        for batch in pieces(batches):
            found = words(encoded(batch.column("text")), ALNUM)
            hashes, at = all_seeds(found, masks)
            one, two = _probes(hashes)
            hit = np.flatnonzero(known[one])
            hit = hit[known[two[hit]]]
            hit = hit[np.argsort(at[hit], kind="stable")]
            places, seeds = at[hit], hashes[hit]
            new = np.ones(len(hit), bool)
            new[1:] = (np.diff(places) > reach) | (np.diff(found.text[places]) > 0)
            cuts = [*np.flatnonzero(new).tolist(), len(hit)]
            rows = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                k = int(found.text[places[a]])
                first = max(int(found.first[k]), int(places[a]) - reach)
                last = min(int(found.first[k + 1]), int(places[b - 1]) + 2 * reach)
                rows.append((k, first - int(found.first[k]), packed(found.hash[first:last]), seeds[a:b].view(np.int64).tolist(), (places[a:b] - first).tolist()))
            own = pa.array([r[0] for r in rows], pa.int64())
            kinds = (pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            columns = [pa.array([r[n + 1] for r in rows], t) for n, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(own), batch.column("print").take(own), *columns],
                names=["doc", "print", "start", "words", "hashes", "places"],
            )

    kind = dict(docs.dtypes)["doc"]
    shape = f"doc {kind}, print binary, start int, words binary, hashes array<bigint>, places array<int>"
    return docs.mapInArrow(read, shape)


def similar_runs(same: np.ndarray, least: int, free: tuple[bool, bool]) -> list[tuple[int, int]]:
    """Unions of all runs of ``least`` words or more of which four of five are equal.

    A run begins and ends with an equal word, or at an edge that is the item's own (``free``).
    """
    sums = np.concatenate(([0], np.cumsum(np.where(same, MATCH, -MISMATCH))))
    begins, ends = np.flatnonzero(np.append(same, False)), np.flatnonzero(np.append(False, same))
    if free[0]:
        begins = np.union1d(begins, [0])
    if free[1]:
        ends = np.union1d(ends, [len(same)])
    if not len(begins) or not len(ends):
        return []
    # the last end from which on no sum reaches that of the beginning
    highest = np.maximum.accumulate(sums[ends][::-1])
    last = np.searchsorted(highest, sums[begins], side="left")
    known = last < len(ends)
    begins, ends = begins[known], ends[::-1][last[known]]
    out: list[tuple[int, int]] = []
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        if b - a >= least:
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
    return out


def verified(candidates: DataFrame, kind_doc: str, kind_item: str, least: int) -> DataFrame:
    """Overlaps of candidates: document stretch, item, and the shift between the two."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, r in enumerate(batch.select(["words", "item_words", "shift", "start"]).to_pylist()):
                doc, item, shift = unpacked(r["words"]), unpacked(r["item_words"]), r["shift"]
                low, high = max(0, -shift), min(len(item), len(doc) - shift)
                if high <= low:
                    continue
                same = item[low:high] == doc[low + shift : high + shift]
                for a, b in similar_runs(same, min(least, len(item)), (low == 0, high == len(item))):
                    equal = int(same[a:b].sum())
                    rows.append((k, r["start"] + shift + low + a, r["start"] + shift + low + b, low + a, equal, equal / len(item)))
            at = pa.array([r[0] for r in rows], pa.int64())
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            columns = [pa.array([r[n + 1] for r in rows], t) for n, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(at) for c in ("doc", "print", "item")], *columns],
                names=["doc", "print", "item", "first_word", "end_word", "item_word", "equal_words", "item_share"],
            )

    shape = f"doc {kind_doc}, print binary, item {kind_item}, first_word bigint, end_word bigint, item_word bigint, equal_words bigint, item_share double"
    return candidates.mapInArrow(read, shape)


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    masks: tuple[str, ...] = MASKS,
    least: int = 13,
) -> DataFrame:
    """Overlaps of ``docs`` with ``items``, both with a column ``text``: one row per document, item and place.

    Columns: ``doc``, ``print`` (of the text), ``item``, word ranges, equal words, and their share of the
    item. An overlap has ``least`` words, or a whole item that is shorter, and four of five agree; it begins and
    ends with an equal word or at an end of the item, and several that touch are one. Words are
    runs of letters and digits without regard to ASCII case. Nulls and empty texts overlap with nothing, nor do items
    under ``LEAST_WORDS`` words. Repeated rows give one result, and so do several seeds of one overlap.
    """
    bench = items.select(F.col(item_id).alias("item"), "text").distinct()
    wording, seeds = benchmark_seeds(bench, masks, LEAST_WORDS)
    longest = (wording.agg(F.max(F.length("words"))).first()[0] or 0) // 8
    plain = docs.select(F.col(doc_id).alias("doc"), fingerprint("text").alias("print"), "text")
    parts = written(stretches(plain, bit_table(seeds), masks, longest)).dropDuplicates(["doc", "print", "start"])
    pairs = parts.select("doc", "print", "start", F.explode(F.arrays_zip("hashes", "places")).alias("p"))
    pairs = pairs.select("doc", "print", "start", F.col("p.hashes").alias("hash"), F.col("p.places").alias("at"))
    hits = pairs.join(seeds, "hash").select("doc", "print", "start", "item", (F.col("at") - F.col("place")).alias("shift")).distinct()
    both = hits.withColumnsRenamed({"doc": "d", "print": "p", "start": "s"}).join(wording.withColumnRenamed("words", "item_words"), "item")
    same: Column = F.col("d").eqNullSafe(F.col("doc")) & (F.col("p") == F.col("print")) & (F.col("s") == F.col("start"))
    candidates = both.join(parts.select("doc", "print", "start", "words"), same).drop("d", "p", "s")
    kinds = dict(candidates.dtypes)
    return verified(candidates, kinds["doc"], kinds["item"], least).distinct()


def decontaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents without any overlap, with all their columns."""
    found = overlaps(docs, items, doc_id, **options).select("doc", "print").distinct()
    own, mark = fresh(docs, "doc", "print")
    found = found.withColumnsRenamed({"doc": own, "print": mark})
    same = docs[doc_id].eqNullSafe(found[own]) & (fingerprint(docs["text"]) == found[mark])
    return docs.join(found, same, "left_anti")
