"""Fingerprints of documents from content-defined chunks.

A gear hash of the last sixteen bytes decides where a text may be cut, so equal passages are cut alike wherever
they stand, and an insertion changes only the chunks around it. Chunk lengths are normalised: up to the
usual length a cut needs eight zero bits of the hash, beyond it only four, and none comes before the
least length or after the most. A fingerprint is the set of the chunks' digests; every digest carries its chunk's
length in its lowest byte. How much of one text another one contains is the length of the
chunks they share.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from forecourt.llm.common import written
from forecourt.llm.tokens import BATCH_BYTES, encoded, mix, pieces

WINDOW = 16  # bytes that a gear hash of sixteen bits remembers
LEAST, USUAL, MOST = 16, 48, 255  # a length must fit a byte
STRICT, LOOSE = 1 << 8, 1 << 12  # hashes below are cuts: eight or four leading zero bits of sixteen
BLOCK = 1 << 20
PART_BYTES = 64 << 20

_U = np.uint64
_GEAR = (mix(np.arange(1001, 1257, dtype=np.uint64)) >> _U(48)).astype(np.uint16)
_VALUES = mix(np.arange(2001, 2257, dtype=np.uint64))
_POWERS = np.cumprod(np.concatenate(([1], np.full(MOST - 1, 0x9E3779B97F4A7C15, np.uint64))), dtype=np.uint64)


def gear(data: np.ndarray) -> np.ndarray:
    """For every byte: the sum of the table's values of the last sixteen bytes, each shifted left once per byte since."""
    total = _GEAR[data]
    for back in (1, 2, 4, 8):
        shifted = total[:-back] << np.uint16(back)
        total = total.copy()
        total[back:] += shifted
    return total


def candidates(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places after which a strict and a loose cut may come, block by block."""
    strict, loose = [], []
    for low in range(0, len(data), BLOCK):
        seen = max(0, low - WINDOW + 1)
        hashes = gear(data[seen : low + BLOCK])[low - seen :]
        places = np.flatnonzero(hashes < LOOSE)
        loose.append(places + low + 1)
        strict.append(places[hashes[places] < STRICT] + low + 1)
    return tuple(np.concatenate([np.zeros(0, np.int64), *found]) for found in (strict, loose))


def following(at, strict, loose):
    """The next cut after each place, as if the text went on for ever."""
    near = np.append(strict, np.iinfo(np.int64).max)[np.searchsorted(strict, at + LEAST)]
    far = np.append(loose, np.iinfo(np.int64).max)[np.searchsorted(loose, at + USUAL)]
    return np.where(near < at + USUAL, near, np.minimum(far, at + MOST))


def cuts(texts: list[bytes]) -> list[list[int]]:
    """Where the chunks of each text begin."""
    gap = bytes(WINDOW)  # what every text is preceded by, so no hash reaches into another text
    data = np.frombuffer(b"".join(part for t in texts for part in (gap, t)), np.uint8)
    strict, loose = candidates(data)
    ends = np.cumsum(np.array([len(t) + WINDOW for t in texts], np.int64))
    starts = ends - [len(t) for t in texts]
    nodes = np.union1d(starts, loose)
    onward = following(nodes, strict, loose)
    place = np.searchsorted(nodes, onward)
    known = np.append(nodes, -1)[place] == onward
    place[~known] = -1
    onward, place, nodes = onward.tolist(), place.tolist(), nodes.tolist()
    out = []
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        found, at, node = [], start, bisect_left(nodes, start)
        while at < end:
            found.append(at - start)
            if node >= 0:
                at, node = onward[node], place[node]
            else:  # after a chunk of the greatest length
                at = int(following(np.array([at]), strict, loose)[0])
                node = bisect_left(nodes, at)
                node = node if node < len(nodes) and nodes[node] == at else -1
        out.append(found)
    return out


def digests(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A digest of every chunk, its length in the lowest byte. Chunks follow each other without a gap."""
    bounds = np.append(start, len(data))
    out = np.empty(len(start), np.uint64)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + BLOCK, side="right")) - 1)
        low, size = bounds[a], np.diff(bounds[a : b + 1])
        within = np.arange(bounds[b] - low) - np.repeat(bounds[a:b] - low, size)
        sums = np.add.reduceat(_VALUES[data[low : bounds[b]]] * _POWERS[within], bounds[a:b] - low)
        out[a:b] = mix(sums) & ~_U(255) | size.astype(np.uint64)
        a = b
    return out


def prints(texts: list[bytes]) -> list[np.ndarray]:
    """The fingerprint of each text: its different digests in order. An empty text has none."""
    found = cuts(texts)
    counts = np.array([len(c) for c in found], np.int64)
    origin = np.cumsum([0, *(len(t) for t in texts)])[:-1]
    owner = np.repeat(np.arange(len(texts)), counts)
    start = np.fromiter((p for c in found for p in c), np.int64, int(counts.sum())) + origin[owner]
    values = digests(np.frombuffer(b"".join(texts), np.uint8), start)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [values[a:b] for a, b in pairwise(bounds.tolist())]


def shown(found: np.ndarray) -> str:
    return base64.b64encode(found.astype("<u8").tobytes()).decode()


def read(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u8")


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """How much of the lighter fingerprint the other one contains, by length; 1 for two empty ones, 0 for one."""
    lighter = min(int((one & _U(255)).sum()), int((other & _U(255)).sum()))
    if not lighter:
        return float(len(one) == len(other))
    shared = np.intersect1d(one, other, assume_unique=True)
    return int((shared & _U(255)).sum()) / lighter


def fingerprints(df: DataFrame) -> DataFrame:
    """Add ``fingerprint`` to a table with ``text``; equal texts have equal ones.

    Null and empty texts have an empty one. A column of that name is replaced. Texts are read whole, very
    long ones block by block.
    """
    df = df.drop("fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = prints(encoded(batch.column("text")))
            yield batch.append_column("fingerprint", pa.array(map(shown, found), pa.string()))

    return df.mapInArrow(run, f"{df._jdf.schema().toDDL()}, fingerprint string")


@F.arrow_udf(DoubleType())
def contained(one: pa.Array, other: pa.Array) -> pa.Array:
    """Likeness of two fingerprint columns; null where one is null."""
    both = zip(one.to_pylist(), other.to_pylist(), strict=True)
    return pa.array([None if a is None or b is None else likeness(read(a), read(b)) for a, b in both], pa.float64())


# --- every document, edited with the beginning of the next one -------------------------------------


def position(row: tuple) -> tuple:
    """Order of rows by id and hash; a missing id is the smallest."""
    return (row[0] is not None, *row)


def ranges(keys: DataFrame, parts: int) -> list[tuple]:
    """The first keys of at most ``parts`` ranges of about equally many rows, in descending order."""
    spread = keys.repartitionByRange(parts, F.col("id").desc_nulls_last(), F.col("hash").desc())
    heads = spread.groupBy(F.spark_partition_id().alias("part")).agg(F.max(F.struct("id", "hash")).alias("key"))
    return sorted(((r.key.id, r.key.hash) for r in heads.collect()), key=position, reverse=True)


def part_of(heads: list[tuple]):
    """Column function: the number of the range that an id and a hash fall in."""
    rising = [position(h) for h in reversed(heads)]

    @F.arrow_udf(IntegerType())
    def part(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        keys = map(position, zip(ids.to_pylist(), hashes.to_pylist(), strict=True))
        return pa.array([len(rising) - 1 - bisect_left(rising, k) for k in keys], pa.int32())

    return part


def with_next(docs: DataFrame, doc_id: str = "doc_id", part_bytes: int = PART_BYTES) -> DataFrame:
    """Texts by range of ids: ``id``, ``text``, ``hash``, ``part`` and ``guest``.

    A task holds a range in descending order of ids (missing ones last; rows of one id by a hash of the text), and behind
    it, as a guest, the first row of the next range; behind the last range, the first row of all. So every row's successor is
    in the same task, and texts are shuffled once. The ranges' first keys, one per task, pass through the driver.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    plain = plain.withColumn("hash", F.xxhash64("text"))
    keys = written(plain.select("id", "hash", F.octet_length("text").alias("size")))
    volume = keys.agg(F.sum("size")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-volume // part_bytes))
    heads = ranges(keys, parts)
    kind = dict(plain.dtypes)["id"]
    known = spark.createDataFrame([(*h, (k - 1) % len(heads)) for k, h in enumerate(heads)], f"head {kind}, head_hash long, part int")
    same: Column = F.col("id").eqNullSafe(F.col("head")) & (F.col("hash") == F.col("head_hash"))
    guests = written(plain.join(F.broadcast(known), same).select("id", "text", "hash", "part")).dropDuplicates(["part"])
    dealt = plain.withColumn("part", part_of(heads)("id", "hash")).withColumn("guest", F.lit(False))
    together = dealt.unionByName(guests.withColumn("guest", F.lit(True)))
    return together.repartitionById(parts, "part").sortWithinPartitions("part", "guest", F.col("id").desc_nulls_last(), F.col("hash").desc())


def edited(text: str, following: str) -> str:
    """The second half of a text replaced by as much of the next one's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edit_prints(docs: DataFrame, doc_id: str = "doc_id", part_bytes: int = PART_BYTES) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text has its last ``floor(n_chars / 2)`` code points replaced by the first as many of the next document
    in descending order of ids; the first document follows the last, and a lone one follows itself. Columns: the id, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, and ``near_edited`` and ``near_next``, the likeness of the fingerprint to the
    edited text's and to the next document's. One row per row: null texts count as empty, missing ids come
    last, rows of one id follow each other by a hash of their texts, and repeated rows follow each other. Other columns are left out.
    An empty table gives an empty one. A task streams its rows; it holds about a megabyte of texts, or one longer text and the next.
    """
    kind = dict(docs.select(F.col(doc_id).alias("id")).dtypes)["id"]
    results = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    schema = f"id {kind}, {results}"

    def rows(ids: list, id_type: pa.DataType, texts: list[bytes]) -> pa.RecordBatch:
        """Results of all rows but the last, which only follows."""
        plain = [t.decode("utf-8", "replace") for t in texts]
        new = [edited(a, b).encode() for a, b in pairwise(plain)]
        own, changed = prints(texts), prints(new)
        columns = [
            pa.array(ids[:-1], id_type),
            pa.array([len(t) for t in plain[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in new], pa.string()),
            pa.array([shown(p) for p in own[:-1]], pa.string()),
            pa.array([shown(p) for p in changed], pa.string()),
            pa.array([likeness(a, b) for a, b in zip(own, changed)], pa.float64()),
            pa.array([likeness(a, b) for a, b in pairwise(own)], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[bytes] = []
        part = None
        for batch in pieces(batches, BATCH_BYTES):
            id_type = batch.column("id").type
            columns = (batch.column(c).to_pylist() for c in ("id", "part"))
            for one, number, text in zip(*columns, encoded(batch.column("text")), strict=True):
                if number != part and texts:  # another range begins
                    if len(texts) > 1:
                        yield rows(ids, id_type, texts)
                    ids, texts = [], []
                part = number
                ids.append(one)
                texts.append(text)
            if len(texts) > 1:
                yield rows(ids, id_type, texts)
                ids, texts = ids[-1:], texts[-1:]

    if docs.isEmpty():
        found = docs.sparkSession.createDataFrame([], schema)
    else:
        found = with_next(docs, doc_id, part_bytes).select("id", "part", "text").mapInArrow(run, schema)
    return found.withColumnRenamed("id", doc_id)
