"""Toxicity as an ordered grade, by cumulative-link regression on sparse text features.

Features of a text are its different words and the first four, five and six bytes of each word
that long, so that inflected forms share weight. One weight per feature serves all grades; ordered
thresholds cut the weighted sum into grades: P(grade <= k) = sigmoid(threshold_k - sum). The
result is the expected grade, and the probability of any grade above 0.

Fitting uses a bounded sample of labelled rows. Feature counts are made on the executors; the
driver gets the most telling features and, for each sampled row, which of those it has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import written
from forecourt.llm.tokens import LETTERS, encoded, mix, pieces, words

PREFIXES = (4, 5, 6)
FILTER_BITS = 20
REJECT = 0.05  # texts whose grade is above 0 with a higher probability are toxic; most others are far below


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (number of the text, feature hash), repeated as often as they occur."""
    found = words(texts, LETTERS)
    length = found.end - found.start
    text, hashes = [found.text], [found.hash]
    for n in PREFIXES:
        long = np.flatnonzero(length >= n)
        heads = _heads(texts, found, long, n)
        text.append(found.text[long])
        hashes.append(mix(heads + np.uint64(n)))
    return np.concatenate(text), np.concatenate(hashes)


def _heads(texts: list[bytes], found, which: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` bytes of some words as one number, in lower case."""
    origin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    at = (origin[found.text] + found.start)[which]
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        byte = data[at + k]
        lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte).astype(np.uint64)
        out = (out << np.uint64(8)) | lower
    return out


@dataclass
class Model:
    codes: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    thresholds: np.ndarray

    def seen(self) -> np.ndarray:
        table = np.zeros(1 << FILTER_BITS, bool)
        table[(self.codes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        return table


def present(texts: list[bytes], codes: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs (number of the text, place of the feature in ``codes``) of a batch."""
    text, hashes = features(texts)
    likely = seen[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
    text, hashes = text[likely], hashes[likely]
    if not len(codes) or not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(codes, hashes), len(codes) - 1)
    hit = codes[at] == hashes
    pairs = np.unique(text[hit].astype(np.int64) * len(codes) + at[hit])
    return pairs // len(codes), pairs % len(codes)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_ordinal(
    rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, width: int, ridge: float = 0.002, steps: int = 2000
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the likelihood of the grades, less a ridge penalty.

    ``rows`` and ``columns`` say which features a text has. Thresholds are the first one and positive
    gaps, so they stay in order. Gradient steps with momentum scaled per parameter (Adam).
    """
    top, n = int(grades.max()), len(grades)
    above = np.clip([(grades > k).mean() for k in range(top)], 1e-4, 1 - 1e-4)
    start = np.log(1 - above) - np.log(above)
    raw = np.concatenate(([start[0]], np.log(np.maximum(np.diff(start), 1e-2)), np.zeros(width)))
    first, second = np.zeros_like(raw), np.zeros_like(raw)
    for step in range(1, steps + 1):
        gaps = np.exp(raw[1:top])
        cuts = np.concatenate(([raw[0]], raw[0] + np.cumsum(gaps)))
        total = np.bincount(rows, raw[top:][columns], n)
        edges = np.concatenate(([-np.inf], cuts, [np.inf]))
        upper, lower = sigmoid(edges[grades + 1] - total), sigmoid(edges[grades] - total)
        chance = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        slope_total = up - low  # of the negative log likelihood
        slope_cuts = np.array([(low * (grades == k + 1)).sum() - (up * (grades == k)).sum() for k in range(top)])
        tail = np.cumsum(slope_cuts[::-1])[::-1]
        slope = np.concatenate(
            (
                [tail[0]],
                gaps * tail[1:],
                np.bincount(columns, slope_total[rows], width) + ridge * raw[top:],
            )
        )
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        rate = 0.1 * (1 - step / (steps + 1))
        raw -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return raw[top:], np.concatenate(([raw[0]], raw[0] + np.cumsum(np.exp(raw[1:top]))))


def telling_features(sample: DataFrame, most: int, least_chi: float) -> DataFrame:
    """Features by how unevenly they fall on texts with label 0 and above: at most ``most`` of them.

    Batches are counted before the shuffle. The measure is the chi-square statistic of presence
    against label; a feature must also occur in three rows. Neither bound rises with the sample. With ``least_chi`` at 20, of a million features that say nothing eight pass; without
    it, features of single texts would explain a small sample and nothing else.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            label = batch.column("label").to_numpy(zero_copy_only=False) > 0
            text, hashes = features(encoded(batch.column("text")))
            codes, place = np.unique(hashes, return_inverse=True)
            pairs = np.unique(place.astype(np.int64) * len(label) + text)
            of, row = pairs // len(label), pairs % len(label)
            counts = [np.bincount(of[label[row] == kind], minlength=len(codes)) for kind in (False, True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes.view(np.int64)), *[pa.array(c.astype(np.int64)) for c in counts]], names=["code", "low", "high"]
            )

    found = sample.mapInArrow(run, "code bigint, low bigint, high bigint").groupBy("code")
    counted = found.agg(F.sum("low").alias("low"), F.sum("high").alias("high"))
    n = sample.agg(F.sum((F.col("label") == 0).cast("long")), F.sum((F.col("label") > 0).cast("long"))).first()
    low, high = float(n[0] or 0), float(n[1] or 0)
    if not low or not high:
        return counted.select("code", F.lit(0.0).alias("chi"), F.lit(False).alias("leans")).limit(0)
    rows, all_rows = F.col("low") + F.col("high"), low + high
    expected = rows * (high / all_rows)
    chi = F.pow(F.col("high") - expected, 2) / expected + F.pow(expected - F.col("high"), 2) / (rows - expected)
    strong = counted.filter(rows >= 3).withColumn("chi", chi).withColumn("leans", F.col("high") > expected)
    return strong.filter(F.col("chi") >= least_chi).orderBy(F.desc("chi"), "code").limit(most)


def without_copies(sample: DataFrame, shingle: int = 5, bands: int = 16, rows: int = 4, least: float = 0.8) -> DataFrame:
    """Leave out near copies of a row with a smaller id: the chance words of a text with thirty copies
    would count thirty times. Rows that share a band of MinHash values are held against each other, and one
    is a copy if ``least`` of all its values equal those of a row that stays. Texts of fewer words than a
    shingle stay. Of the bounded sample, ids and these values reach the driver.
    """
    values = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = words(encoded(batch.column("text")), LETTERS)
            grams, at = found.ngrams(shingle)
            text = found.text[at]
            starts = np.flatnonzero(np.diff(np.concatenate(([-1], text))))
            low: list[bytes | None] = [None] * batch.num_rows
            if len(starts):
                least_of = [np.minimum.reduceat(mix(grams + np.uint64(k)), starts) for k in range(values)]
                for k, signature in zip(text[starts].tolist(), np.stack(least_of, 1), strict=True):
                    low[k] = signature.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(low, pa.binary())], names=["doc_id", "low"])

    kind = dict(sample.dtypes)["doc_id"]
    found = sample.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, low binary").collect()
    holders: dict[tuple[int, bytes], list[np.ndarray]] = {}
    keep = []
    for row in sorted(found, key=lambda r: r["doc_id"]):
        if row["low"] is not None:
            signature = np.frombuffer(row["low"], np.uint64)
            keys = [(k, signature[k * rows : (k + 1) * rows].tobytes()) for k in range(bands)]
            near = [other for key in keys for other in holders.get(key, ())]
            if near and (np.stack(near) == signature).mean(1).max() >= least:
                continue
            for key in keys:
                holders.setdefault(key, []).append(signature)
        keep.append((row["doc_id"],))
    kept = sample.sparkSession.createDataFrame(keep, f"doc_id {kind}")
    return sample.join(F.broadcast(kept), "doc_id")


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Texts and labels of about ``most`` labelled rows, drawn by a hash of the id, without near copies.

    ``labels`` has ``doc_id`` and ``label``; null ids, labels and texts are left out, and of several
    labels for an id the largest counts. The sample of ids is bounded, so it is broadcast.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    share = most / max(1, known.count())
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    drawn = known.filter(draw < int(min(1.0, share) * (1 << 30))).groupBy("doc_id").agg(F.max("label").alias("label"))
    drawn = drawn.orderBy(F.xxhash64("doc_id")).limit(most)
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(drawn), "doc_id")
    sample = written(texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")))
    return without_copies(sample).select("text", "label")


def learn(
    sample: DataFrame,
    grades: int = 3,
    most_features: int = 1 << 13,
    least_chi: float = 20.0,
    ridge: float = 0.002,
) -> Model | None:
    """Fit grades 0 to ``grades - 1`` on a bounded sample with columns ``text`` and ``label``.

    ``most_features`` bounds the model that every task gets; of more telling features the strongest count.

    A label above 1 is a grade as it stands. If labels only say toxic or not, the severity of a toxic
    text is how many different telling features that lean to toxic texts it has, cut at quantiles into
    the grades above 0. Without both kinds of labels there is no model.
    """
    sample = sample.select("text", F.col("label").cast("int").alias("label"))
    chosen = telling_features(sample, most_features, least_chi).collect()
    codes = np.array([r["code"] for r in chosen], np.int64).view(np.uint64)
    leans = np.array([bool(r["leans"]) for r in chosen], bool)
    order = np.argsort(codes)
    codes, leans = codes[order], leans[order]
    model = Model(codes, np.zeros(len(codes)), np.zeros(grades - 1))
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        seen = found.seen()
        for batch in pieces(batches):
            row, column = present(encoded(batch.column("text")), found.codes, seen)
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            lists = [column[cuts[k] : cuts[k + 1]].tolist() for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(lists, pa.list_(pa.int32()))], names=["label", "has"])

    rows = sample.mapInArrow(run, "label int, has array<int>").collect()
    rows.sort(key=lambda r: (r["label"], r["has"]))
    labels = np.array([r["label"] for r in rows], np.int64)
    if not len(labels) or labels.max() == labels.min() or not len(codes):
        return None
    row = np.repeat(np.arange(len(rows)), [len(r["has"]) for r in rows])
    column = np.array([c for r in rows for c in r["has"]], np.int64)
    if labels.max() == 1 and grades > 2:
        leaning = np.bincount(row[leans[column]], minlength=len(rows))
        cuts = np.quantile(leaning[labels == 1], [k / (grades - 1) for k in range(1, grades - 1)])
        labels = np.where(labels == 1, 1 + np.searchsorted(cuts, leaning, side="left"), 0)
    model.weights, model.thresholds = fit_ordinal(row, column, np.minimum(labels, grades - 1), len(codes), ridge)
    return model


def above(texts: pa.Array, model: Model | None, seen: np.ndarray | None) -> np.ndarray:
    """Per threshold and text, the probability of a grade above it; 0 without a model."""
    if model is None:
        return np.zeros((1, len(texts)))
    row, column = present(encoded(texts), model.codes, seen)
    total = np.bincount(row, model.weights[column], len(texts))
    return np.array([sigmoid(total - cut) for cut in model.thresholds])


def grade(df: DataFrame, model: Model | None) -> DataFrame:
    """Add ``severity``, the expected grade, and ``p_toxic``, the probability of a grade above 0.

    A null or empty text has no features and gets what the thresholds alone say. Without a model both
    are 0. Columns of these names are replaced; all others, ``text`` among them, stay as they are.
    """
    names = ["severity", "p_toxic"]
    df = df.drop(*names)
    schema = f"{df._jdf.schema().toDDL()}, severity double, p_toxic double"
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        seen = found.seen() if found else None
        for batch in pieces(batches):
            chance = above(batch.column("text"), found, seen)
            added = [pa.array(chance.sum(0)), pa.array(chance[0])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *names])

    return df.mapInArrow(run, schema)


def bound(model: Model | None, most: float = REJECT) -> float:
    """The probability above which a text is toxic: ``most``, but no less than what a text without any telling feature gets.

    Where toxic rows are frequent or features few, the thresholds alone can grant more than ``most`` to every text.
    """
    return most if model is None else max(most, float(sigmoid(-model.thresholds[0])) * (1 + 1e-9))


def accepted(df: DataFrame, model: Model | None, most: float = REJECT) -> DataFrame:
    """The rows whose probability of a grade above 0 is at most ``most``, or that of a text without features, with all their columns."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    most = bound(model, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        seen = found.seen() if found else None
        for batch in pieces(batches):
            yield batch.filter(pa.array(above(batch.column("text"), found, seen)[0] <= most))

    return df.mapInArrow(run, df.schema)


def learn_from_tables(docs: DataFrame, labels: DataFrame, label: str, most_rows: int = 20_000) -> Model | None:
    """Fit on at most ``most_rows`` labelled documents; ``label`` names the column of ``labels``."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    return learn(labelled_sample(docs, known, most_rows))
