"""Similarity join on word shingles, with Bayesian pruning of candidates.

1. Equal texts are one text from here on; copies are only counted.
2. Every text gets MinHash values of its shingles. Texts that agree in three values of any band
   share a bucket. At a similarity of 0.8, twenty bands miss one pair in a million.
3. In a bucket, pairs compare their values sixteen at a time; a pair is dropped as soon as the posterior
   probability that its similarity reaches the threshold is below the tolerance. What stays
   connects texts to clusters.
4. In a cluster, pairs are compared the same way once more, and those that stay are verified on their
   shingle sets. So a text travels once per cluster, not once per bucket.

No step emits the pairs of a group. A large bucket or cluster is cut into blocks, and each pair of blocks is
a group of its own, of bounded size, in which pairs exist only as arrays; it yields for each text the number
of its links and one edge that ties it to its component. So no link is lost, and rows stay linear.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import fingerprint, fresh, written
from forecourt.llm.components import components
from forecourt.llm.tokens import Words, combine, encoded, mix, pieces, words

SHINGLE, THRESHOLD = 5, 0.8
VALUES, BANDS, ROWS = 64, 20, 3
STEP, TOLERANCE = 16, 1e-6
BUCKET_BLOCK, CLUSTER_BLOCK = 512, 128

_FACTORS = mix(np.arange(101, 101 + VALUES, dtype=np.uint64)) | np.uint64(1)


def shingles(found: Words, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes and the number of their text. A text with too few words is one shingle of all of them."""
    grams, at = found.ngrams(SHINGLE)
    owner = found.text[at]
    sizes = np.diff(found.first)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        own = [combine([found.hash[k : k + 1] for k in range(found.first[t], found.first[t + 1])], t_seed) for t, t_seed in ((t, int(sizes[t])) for t in short)]
        grams = np.concatenate([grams, *own])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        grams, owner = grams[order], owner[order]
    return grams, owner


def least_agreement(threshold: float, tolerance: float) -> list[int]:
    """For 16, 32, ... compared values: how many must agree for a pair to stay.

    With a uniform prior, the similarity of a pair with m of n values equal has a beta distribution;
    its upper tail is a sum of binomial terms.
    """
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        low = 0
        for m in range(n + 1):
            tail = sum(math.comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1))
            if tail >= tolerance:
                low = m
                break
        out.append(low)
    return out


def surviving(left: np.ndarray, right: np.ndarray, needed: list[int]) -> np.ndarray:
    """Which rows of two tables of values, side by side, may still reach the threshold."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), np.int16)
    for step, least in enumerate(needed):
        part = slice(step * STEP, (step + 1) * STEP)
        equal = equal + (left[alive, part] == right[alive, part]).sum(1, dtype=np.int16)
        stay = equal >= least
        alive, equal = alive[stay], equal[stay]
    return alive


def signatures(docs: DataFrame) -> DataFrame:
    """Per different text: ``print``, ``values`` (one byte per MinHash value) and the hashes of its ``bands``.

    Texts without a word have none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            grams, owner = shingles(words(encoded(batch.column("text"))), batch.num_rows)
            starts = np.flatnonzero(np.diff(np.concatenate(([-1], owner))))
            if not len(starts):
                continue
            low = np.empty((len(starts), VALUES), np.uint64)
            for k, factor in enumerate(_FACTORS):
                low[:, k] = np.minimum.reduceat(grams * factor, starts)
            bands = np.column_stack([combine([low[:, ROWS * b + r] for r in range(ROWS)], b + 1) for b in range(BANDS)])
            small = (mix(low) & np.uint64(0xFF)).astype(np.uint8)
            at = pa.array(owner[starts])
            columns = [
                batch.column("print").take(at),
                pa.array([row.tobytes() for row in small], pa.binary()),
                pa.array(bands.view(np.int64).tolist(), pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["print", "values", "bands"])

    found = docs.mapInArrow(run, "print binary, values binary, bands array<bigint>")
    return found.groupBy("print").agg(F.first("values").alias("values"), F.first("bands").alias("bands"))


def in_blocks(rows: DataFrame, key: str, item: str, size: str, block: int) -> DataFrame:
    """Cut groups of more than ``block`` rows: adds ``i`` and ``j``, the pair of blocks, and ``side``.

    A row of block b is dealt to the pairs of b with every block of its group, so each pair of rows
    meets exactly once: in (b, b) if both are in block b, else across the two sides of (i, j).
    """
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(item), blocks)
    out = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    out = out.withColumn("i", F.least("own", "other").cast("int")).withColumn("j", F.greatest("own", "other").cast("int"))
    side = (F.col("own") == F.col("j")) & (F.col("i") != F.col("j"))
    out = out.withColumn("side", side).drop("own", "other", size)
    return out.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j")


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows as tables of at least ``rows`` rows that end where a group ends, and where groups begin."""
    held: list[pa.RecordBatch] = []

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for name in (key, "i", "j"):
            column = table.column(name).combine_chunks()
            new[1:] |= pa.compute.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        return np.flatnonzero(new)

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            table = pa.Table.from_batches(held)
            found = starts(table)
            if len(found) > 1:
                yield table.slice(0, found[-1]), found[:-1]
                held = table.slice(found[-1]).to_batches()
            else:
                held = table.to_batches()
    if sum(b.num_rows for b in held):
        table = pa.Table.from_batches(held)
        yield table, starts(table)


def group_pairs(starts: np.ndarray, ends: np.ndarray, side: np.ndarray, cross: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of all pairs to compare, in arrays: small groups together, by distance; large ones one by one."""
    sizes = ends - starts
    group = np.repeat(np.arange(len(starts)), sizes)
    large = sizes > 64
    for g in np.flatnonzero(large).tolist():
        rows = np.arange(starts[g], ends[g])
        if cross[g]:
            left, right = rows[~side[rows]], rows[side[rows]]
            for row in left.tolist():
                yield np.full(len(right), row), right
        else:
            for row in rows[:-1].tolist():
                yield np.full(ends[g] - row - 1, row), np.arange(row + 1, ends[g])
    rows = np.flatnonzero(~large[group])
    for distance in range(1, 64):
        rows = rows[rows + distance < ends[group[rows]]]
        if not len(rows):
            break
        across = ~cross[group[rows]] | (side[rows] != side[rows + distance])
        yield rows[across], rows[across] + distance


def tied(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each of ``n`` rows is connected with by pairs."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _edges(prints: pa.Array, label: np.ndarray) -> list[pa.Array]:
    moved = np.flatnonzero(label != np.arange(len(label)))
    return [prints.take(pa.array(moved)), prints.take(pa.array(label[moved]))]


def candidate_edges(signed: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Edges ``a``, ``b`` that connect all texts with a pair that shares a bucket and survives pruning."""
    needed = least_agreement(threshold, tolerance)
    entries = signed.select("print", F.explode("bands").alias("band"))
    shared = entries.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    filled = entries.join(shared, "band").join(signed.select("print", "values"), "print")
    cells = in_blocks(filled, "band", "print", "size", BUCKET_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, "band", 8192):
            values = np.frombuffer(b"".join(table.column("values").to_pylist()), np.uint8).reshape(-1, VALUES)
            side = table.column("side").to_numpy()
            cross = (table.column("i").to_numpy() != table.column("j").to_numpy())[starts]
            ends = np.concatenate((starts[1:], [table.num_rows]))
            kept = []
            for a, b in group_pairs(starts, ends, side, cross):
                stay = surviving(values[a], values[b], needed)
                kept.append((a[stay], b[stay]))
            a, b = (np.concatenate([k[n] for k in kept] or [np.zeros(0, np.int64)]) for n in (0, 1))
            prints = table.column("print").combine_chunks()
            yield pa.RecordBatch.from_arrays(_edges(prints, tied(table.num_rows, a, b)), names=["a", "b"])

    return cells.mapInArrow(run, "a binary, b binary")


def links(texts: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Verified links in clusters: rows (print, tie, n), the number of links of a text in a pair of blocks and
    the text it is tied to there. ``texts`` has ``root``, ``print``, ``values``, ``size`` and ``text``."""
    needed = least_agreement(threshold, tolerance)
    cells = in_blocks(texts, "root", "print", "size", CLUSTER_BLOCK)

    def verified(table: pa.Table) -> pa.RecordBatch:
        n = table.num_rows
        values = np.frombuffer(b"".join(table.column("values").to_pylist()), np.uint8).reshape(-1, VALUES)
        side = table.column("side").to_numpy()
        cross = np.array([table.column("i")[0].as_py() != table.column("j")[0].as_py()])
        sets = []
        for text in encoded(table.column("text").combine_chunks()):
            sets.append(np.unique(shingles(words([text]), 1)[0]))
        degree = np.zeros(n, np.int64)
        kept: tuple[list, list] = ([], [])
        everything, place = np.unique(np.concatenate(sets), return_inverse=True)
        cuts = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
        own = [place[cuts[k] : cuts[k + 1]] for k in range(n)]
        partners: dict[int, list[np.ndarray]] = {}
        for a, b in group_pairs(np.array([0]), np.array([n]), side, cross):
            stay = surviving(values[a], values[b], needed)
            for row in np.unique(a[stay]).tolist():
                partners.setdefault(row, []).append(b[stay][a[stay] == row])
        marked = np.zeros(len(everything), bool)
        for row, found in partners.items():
            marked[own[row]] = True
            for other in np.concatenate(found).tolist():
                both = int(np.count_nonzero(marked[own[other]]))
                if both >= threshold * (len(own[row]) + len(own[other]) - both) - 1e-9:
                    degree[[row, other]] += 1
                    kept[0].append(row)
                    kept[1].append(other)
            marked[own[row]] = False
        label = tied(n, np.array(kept[0], np.int64), np.array(kept[1], np.int64))
        linked = pa.array(np.flatnonzero(degree))
        prints = table.column("print").combine_chunks()
        columns = [prints.take(linked), prints.take(pa.array(label[linked.to_numpy()])), pa.array(degree).take(linked)]
        return pa.RecordBatch.from_arrays(columns, names=["print", "tie", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, "root", 1):
            ends = [*starts[1:].tolist(), table.num_rows]
            for start, end in zip(starts.tolist(), ends, strict=True):
                yield verified(table.slice(start, end - start))

    return cells.mapInArrow(run, "print binary, tie binary, n bigint")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", threshold: float = THRESHOLD, tolerance: float = TOLERANCE
) -> DataFrame:
    """One row per document: ``doc_id``, ``print`` (of its text), ``class_id``, ``n_links``, ``n_copies``, ``first``.

    A class is a connected component of links; its id is the least id in it. ``n_links`` counts the
    different texts with which the document's text has a Jaccard similarity of at least ``threshold`` on sets
    of five-word shingles, ``n_copies`` the rows with the same text, itself included. ``first`` is true for
    the text that stands for its class: the one with the least id, and of several the least print.

    Words are runs of bytes other than ASCII blanks, as they stand. A text of one to four words is one
    shingle. Texts without words have only copies. A null text is alone in its class. Null ids sort last.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), fingerprint("text").alias("print"), "text")
    ids = written(plain.select("doc_id", "print"))
    groups = written(ids.filter("print is not null").groupBy("print").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies")))
    signed = written(signatures(plain.filter("print is not null").select("print", "text")))
    clusters = written(components(candidate_edges(signed, threshold, tolerance)))
    sizes = clusters.groupBy("root").agg(F.count("*").alias("size"))
    members = clusters.join(sizes, "root").withColumnRenamed("node", "print").join(groups.select("print", "rep"), "print")
    same: Column = F.col("t.doc_id").eqNullSafe(F.col("m.rep")) & (F.col("t.print") == F.col("m.print"))
    texts = plain.alias("t").join(members.alias("m"), same).select("m.print", "m.root", "m.size", "t.text").dropDuplicates(["print"])
    found = written(links(texts.join(signed.select("print", "values"), "print"), threshold, tolerance))
    degrees = found.groupBy("print").agg(F.sum("n").alias("n_links"))
    roots = components(found.select(F.col("print").alias("a"), F.col("tie").alias("b")))
    texts_in = (
        groups.join(roots.withColumnRenamed("node", "print"), "print", "left")
        .join(degrees, "print", "left")
        .withColumn("root", F.coalesce("root", "print"))
    )
    least = F.min(F.struct(F.col("rep").isNull().alias("none"), F.col("rep").alias("id"), F.col("print").alias("print")))
    classes = texts_in.groupBy("root").agg(least.alias("least"))
    judged = texts_in.join(classes, "root").select(
        F.col("print").alias("p"),
        F.col("least.id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "n_copies",
        (F.col("least.print") == F.col("print")).alias("first"),
        "rep",
    )
    joined = ids.join(judged, F.col("print") == F.col("p"), "left")
    alone = F.col("print").isNull()
    return joined.select(
        "doc_id",
        "print",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.when(alone, True).otherwise(F.col("first") & F.col("doc_id").eqNullSafe(F.col("rep"))).alias("first"),
    )


def one_per_class(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The document of each class that has the least id, with all its columns. Null texts all stay."""
    kept = near_duplicates(docs, doc_id, **options).filter("first and print is not null").select("doc_id", "print").distinct()
    own, mark = fresh(docs, "own", "mark")
    kept = kept.withColumnsRenamed({"doc_id": own, "print": mark})
    same = docs[doc_id].eqNullSafe(kept[own]) & (fingerprint(docs["text"]) == kept[mark])
    firsts = docs.join(kept, same).dropDuplicates([own, mark]).drop(own, mark)
    return firsts.unionByName(docs.filter(F.col("text").isNull()))
