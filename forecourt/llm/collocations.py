"""Phrases whose words belong together, from count streams in prefix and suffix order.

Phrases are counted length by length. A phrase of m words is known by two numbers, that of its first m - 1 words and that of
its last m - 1 words, down to single words, whose number is a 64-bit hash of the word and its language. A pass over the
texts counts only phrases both of whose shorter parts are frequent enough, which loses nothing, since a phrase is
never more frequent than its parts. The frequent phrases of each length are one stream of counts. Sorted by the first part (prefix
order) the stream runs in step with the stream of the shorter length, and a merge join hands down the counts of
everything the phrase begins with; sorted by the last part (suffix order) it gets the counts of everything the phrase ends
with. Going the other way, a shorter phrase gets the greatest count among its extensions by a word on either side. No hash
table holds phrases at any point; words are looked up again only for phrases that are returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from forecourt.llm.common import fresh, written
from forecourt.llm.tokens import Alphabet, combine, encoded, mix, pieces, words

BLANKS, STOPS = b" \t", b".,;:!?\n\x0b\x0c\r"
WORDS = Alphabet(BLANKS + STOPS, lower=True)
GATHER = 1 << 21  # different phrases that a task adds up before it hands them on
SLICE_BYTES = 32 << 20  # of text; what a task adds up from all others comes from about so much
LEAST_BITS, MOST_BITS = 22, 28  # size of the table that passes use to leave out rare phrases
LANES = 64

_U = np.uint64
_STOP = np.zeros(256, bool)
_STOP[list(STOPS)] = True


def language(name: str) -> int:
    """A number for a language, so that equal words of two languages have different numbers."""
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


def scanned(texts: list[bytes], langs: list[str]):
    """Words of texts, their numbers, and for each word the number of the piece it stands in."""
    found = words(texts, WORDS)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    origin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)  # a line end between texts, so no piece spans two
    piece = np.cumsum(_STOP[data], dtype=np.int64)[origin[found.text] + found.start]
    seeds = {name: language(name) for name in set(langs)}
    number = mix(found.hash + np.array([seeds[name] for name in langs], np.uint64)[found.text])
    return found, number, piece


def joined(first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Numbers of phrases from those of their two shorter parts."""
    return combine([first, last], length)


class Known:
    """A table of bits that has all numbers of a set, and few others."""

    def __init__(self, bits: int, table: np.ndarray):
        self.bits, self.table = bits, table

    def has(self, numbers: np.ndarray) -> np.ndarray:
        one, two = numbers >> _U(64 - self.bits), numbers & _U((1 << self.bits) - 1)
        return self._bit(one) & self._bit(two)

    def _bit(self, at: np.ndarray) -> np.ndarray:
        return (self.table[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8) & 1).astype(bool)


def bit_table(numbers: DataFrame) -> tuple[int, np.ndarray]:
    """Two bits for each ``id``, in a table of 32 bits per number but never more than ``2**MOST_BITS``.

    Beyond that size it leaves out fewer rare phrases; nothing frequent is ever missed.
    """
    n = numbers.count()
    bits = min(max(LEAST_BITS, (32 * n).bit_length()), MOST_BITS)
    one, two = F.shiftrightunsigned("id", 64 - bits), F.col("id").bitwiseAND((1 << bits) - 1)
    cells = numbers.select(F.explode(F.array(one, two)).alias("bit")).groupBy(F.shiftright("bit", 5).alias("cell"))
    rows = cells.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("mask")).toArrow()
    table = np.zeros((1 << bits) // 32, "<u4")
    table[rows.column("cell").to_numpy()] = rows.column("mask").to_numpy()
    return bits, table.view(np.uint8)


def _added(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Phrases of several lists, each once: number, first part, last part, language, summed count."""
    number, first, last, lang, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(number, kind="stable")
    number = number[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(len(number), 1), bool), number[1:] != number[:-1])))
    kept = order[starts]
    return number[starts], first[kept], last[kept], lang[kept], np.add.reduceat(count[order], starts) if len(starts) else count


def _found(texts: list[bytes], langs: list[str], length: int, known: Known | None):
    """Phrases of one length in some texts, each once: number, first part, last part, count, and the text of one of them."""
    scan, number, piece = scanned(texts, langs)
    at = np.arange(len(number))
    first = last = number
    for size in range(2, length + 1):
        whole = number
        n = len(whole)
        fits = np.flatnonzero(at[1:] - at[:-1] == 1) if n > 1 else np.zeros(0, np.int64)
        fits = fits[piece[at[fits]] == piece[at[fits] + size - 1]]
        if size == length and known is not None:
            good = known.has(whole)
            fits = fits[good[fits] & good[fits + 1]]
        first, last, at = whole[fits], whole[fits + 1], at[fits]
        number = joined(first, last, size)
    unique, index, count = np.unique(number, return_index=True, return_counts=True)
    return unique, first[index], last[index], count.astype(np.int64), scan.text[at[index]]


def counted(docs: DataFrame, length: int, slices: int, known: tuple[int, np.ndarray] | None) -> DataFrame:
    """Packed counts of the phrases of one length, dealt by slices of their numbers.

    A frequent phrase is added up in every task before it is shuffled, so it is no hot key.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known) if known else None

    def parcels(held: list, names: list[str]) -> Iterator[pa.RecordBatch]:
        number, first, last, lang, count = _added(held)
        part = ((number >> _U(32)) * _U(slices) >> _U(32)).astype(np.int64)
        order = np.lexsort((number, lang, part))
        part, lang, first, last, count = (x[order] for x in (part, lang, first, last, count))
        new = np.flatnonzero((np.diff(part, prepend=-1) != 0) | (np.diff(lang, prepend=-1) != 0)).tolist()
        for a, b in zip(new, [*new[1:], len(part)], strict=True):
            packed = [x[a:b].astype("<u8").tobytes() for x in (first, last, count)]
            row = [pa.array([int(part[a])], pa.int32()), pa.array([names[lang[a]]], pa.string()), *[pa.array([x], pa.binary()) for x in packed]]
            yield pa.RecordBatch.from_arrays(row, names=["slice", "lang", "first", "last", "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Known(*shared.value) if shared else None
        held, names, size = [], {}, 0
        for batch in pieces(batches):
            langs = batch.column("lang").to_pylist()
            number, first, last, count, text = _found(encoded(batch.column("text")), langs, length, table)
            places = np.array([names.setdefault(name, len(names)) for name in langs], np.int64)
            held.append((number, first, last, places[text], count))
            size += len(number)
            if size >= GATHER:
                held = [_added(held)]
                size = len(held[0][0])
                if size >= GATHER // 2:  # adding up didn't help much
                    yield from parcels(held, list(names))
                    held, names, size = [], {}, 0
        if size:
            yield from parcels(held, list(names))

    shape = "slice int, lang string, first binary, last binary, count binary"
    return docs.mapInArrow(run, shape).repartitionById(slices, "slice")


def frequent(parcels: DataFrame, length: int, least: int) -> DataFrame:
    """Phrases with at least ``least`` occurrences: ``lang``, ``id``, ``first``, ``last`` and ``n``; of
    single words also one row per slice and language without ``id``, with the occurrences of all its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                first, last, count = (np.frombuffer(row[c], "<u8") for c in ("first", "last", "count"))
                number = first if length == 1 else joined(first, last, length)
                held.setdefault(row["lang"], []).append((number, first, last, np.zeros(len(first), np.int64), count.astype(np.int64)))
        for lang, rows in held.items():
            number, first, last, _, count = _added(rows)
            total = int(count.sum())
            kept = count >= least
            columns = [pa.array(x[kept].view(np.int64), pa.int64()) for x in (number, first, last, count)]
            langs = pa.array([lang] * int(kept.sum()), pa.string())
            yield pa.RecordBatch.from_arrays([langs, *columns], names=names)
            if length == 1:
                row = [pa.array([lang]), *[pa.array([None], pa.int64())] * 3, pa.array([total], pa.int64())]
                yield pa.RecordBatch.from_arrays(row, names=names)

    names = ["lang", "id", "first", "last", "n"]
    return written(parcels.mapInArrow(run, "lang string, id bigint, first bigint, last bigint, n bigint"))


def streams(docs: DataFrame, most_words: int, least: int) -> tuple[list[DataFrame], DataFrame]:
    """Count streams of one to ``most_words`` words, as far as there are any, and ``lang`` with ``total`` words."""
    spark = docs.sparkSession
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-volume // SLICE_BYTES))
    singles = frequent(counted(docs, 1, slices, None), 1, least)
    totals = singles.filter(F.col("id").isNull()).groupBy("lang").agg(F.sum("n").alias("total"))
    found = [singles.filter(F.col("id").isNotNull())]
    for length in range(2, most_words + 1):
        if found[-1].isEmpty():
            break
        found.append(frequent(counted(docs, length, slices, bit_table(found[-1])), length, least))
    return found, totals


def extended(longer: DataFrame) -> DataFrame:
    """The greatest count among the extensions of a phrase by one word, ``most``, by its ``part``."""
    sides = [longer.select(F.col(side).alias("part"), F.col("n").alias("most")) for side in ("first", "last")]
    return sides[0].unionAll(sides[1]).groupBy("part").agg(F.max("most").alias("most"))


def merged(found: list[DataFrame]) -> DataFrame:
    """All phrases of two words and more: their count ``a``, ``lefts`` and ``rights``, the counts of the two
    sides of each cut, and ``most``, the greatest count of an extension."""
    empty = F.array().cast("array<bigint>")
    shorter = found[0].select("id", "n", empty.alias("lefts"), empty.alias("rights"))
    out = []
    for place, stream in enumerate(found[1:], 1):
        prefixes = shorter.select(F.col("id").alias("first"), F.concat("lefts", F.array("n")).alias("lefts"))
        suffixes = shorter.select(F.col("id").alias("last"), F.concat(F.array("n"), "rights").alias("rights"))
        in_prefix_order = stream.join(prefixes.hint("merge"), "first")
        shorter = written(in_prefix_order.join(suffixes.hint("merge"), "last").select("lang", "id", "n", "lefts", "rights"))
        if place + 1 < len(found):
            known = extended(found[place + 1])
            whole = shorter.join(known.hint("merge"), shorter["id"] == known["part"], "left").drop("part")
        else:
            whole = shorter.withColumn("most", F.lit(None).cast("long"))
        out.append(whole.withColumnRenamed("n", "a"))
    whole = out[0]
    for other in out[1:]:
        whole = whole.unionByName(other)
    return whole


def exact(name: str | Column, digits: int) -> Column:
    return (F.col(name) if isinstance(name, str) else name).cast(f"decimal({digits},0)")


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Counts of the weakest cut, ``l`` and ``r``, and its ``score``, of phrases that no extension replaces.

    Products are decimals of 38 digits, exact for up to 10^17 words.
    """
    kept = phrases.filter(F.col("most").isNull() | (F.col("most") < F.col("a"))).join(totals, "lang")
    over = exact(1000 * F.col("a"), 20) * exact("total", 17)

    def cut(left: Column, right: Column) -> Column:
        return F.struct(left.alias("l"), right.alias("r"), (exact(left, 18) * exact(right, 18)).alias("under"))

    sides = kept.withColumn("cuts", F.zip_with("lefts", "rights", cut)).withColumn("over", over)
    quotient = "transform(cuts, (c, k) -> struct(over div c.under as score, k as place, c.l as l, c.r as r))"
    weakest = sides.withColumn("weakest", F.array_min(F.expr(quotient)))
    return weakest.select("lang", "id", "a", "weakest.l", "weakest.r", F.col("total").alias("n"), "weakest.score")


def best(found: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language by score and count, and all that tie with the last of them.

    They are first chosen in lanes, so a language with most of the phrases isn't ranked by one task.
    """
    order = [F.col("score").desc(), F.col("a").desc()]
    lane, rank = fresh(found, "lane", "rank")
    found = found.withColumn(lane, F.pmod("id", F.lit(LANES)))
    for keys in (["lang", lane], ["lang"]):
        found = found.withColumn(rank, F.rank().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= top).drop(rank)
    return found.drop(lane)


def spelled(docs: DataFrame, wanted: DataFrame, most_words: int) -> DataFrame:
    """``id`` and ``phrase`` of the wanted phrases, from the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(wanted.select("id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(*shared.value)
        seen: set[int] = set()
        for batch in pieces(batches):
            texts = encoded(batch.column("text"))
            scan, number, piece = scanned(texts, batch.column("lang").to_pylist())
            rows = {}
            for size in range(2, most_words + 1):
                number = joined(number[:-1], number[1:], size) if len(number) else number
                whole = piece[: len(number)] == piece[size - 1 :]
                for at in np.flatnonzero(known.has(number) & whole).tolist():
                    one = int(number[at].view(np.int64))
                    if one not in seen:
                        seen.add(one)
                        own = texts[scan.text[at]]
                        spans = zip(scan.start[at : at + size].tolist(), scan.end[at : at + size].tolist(), strict=True)
                        rows[one] = b" ".join(own[a:b] for a, b in spans).lower().decode("utf-8", "replace")
            if len(seen) > GATHER:
                seen.clear()
            columns = [pa.array(list(rows), pa.int64()), pa.array(list(rows.values()), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "phrase"])

    found = docs.mapInArrow(run, "id bigint, phrase string")
    return found.join(wanted.select("id"), "id", "left_semi").groupBy("id").agg(F.min("phrase").alias("phrase"))


def collocations(docs: DataFrame, most_words: int = 5, least: int = 100, top: int | None = 2000) -> DataFrame:
    """Phrases of two to ``most_words`` words, best first, for each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces into words at blanks and tabs. A
    phrase counts if it occurs ``least`` times within pieces of its language (``a``; overlaps count). Cut in
    two, its score is floor(1000 a n / (l r)), with ``n`` words in the language and ``l`` and ``r`` occurrences of the two sides; the
    cut with the lowest score counts, the first of several. A phrase that is always part of a longer one
    that counts is left out. Each language returns its first ``top`` by score, count and spelling (all for None).

    A null ``lang`` is ``und``; null and empty texts have no words; repeated rows count as often as they occur; other columns
    are ignored; an empty table gives no rows. Texts are read whole, about a megabyte or one text at a time. Phrases are told apart by
    64-bit numbers.
    """
    lang = F.coalesce(F.col("lang"), F.lit("und")).alias("lang")
    docs = docs.select(lang, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found, totals = streams(docs, most_words, least)
    shape = "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"
    if len(found) < 2:
        return docs.sparkSession.createDataFrame([], shape)
    chosen = scored(merged(found), totals)
    chosen = written(best(chosen, top) if top is not None else chosen)
    named = chosen.join(spelled(docs, chosen, most_words), "id")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
