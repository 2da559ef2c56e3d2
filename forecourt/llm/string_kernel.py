"""Language identification with a string kernel.

Two texts are as similar as the number of different byte n-grams (one to three bytes) that occur
in both, over the geometric mean of their own numbers: a blended-spectrum presence kernel. Landmark
texts span an approximation of its feature space (Nyström), and one ridge regression per language
says which side of it a text is on.

The kernel between a batch of texts and the landmarks is the product of two presence matrices, and
the regression multiplies the result by a small matrix. That small matrix and the landmarks' presences
don't depend on the batch, so they are multiplied once, after the fit; a batch then costs one
product of its sparse presences with a matrix of n-grams by languages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.tokens import pieces

SPACE = (1 << 8) + (1 << 16) + (1 << 24)  # all n-grams of one, two and three bytes
PART = 1 << 20
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
# Digits, signs and control bytes say nothing about the language: one blank for each.
_READ = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))

_scratch: dict[str, np.ndarray] = {}


def _grams(data: np.ndarray) -> np.ndarray:
    wide = data.astype(np.int32)
    two = (wide[:-1] << 8) | wide[1:]
    three = (two[:-1] << 8) | wide[2:]
    return np.concatenate([wide, two + (1 << 8), three + (1 << 8) + (1 << 16)])


def presence(text: str) -> np.ndarray:
    """Codes of the different n-grams of a whole text, lower-cased, in no particular order."""
    if "seen" not in _scratch:
        _scratch["seen"] = np.zeros(SPACE, np.int32)
    seen = _scratch["seen"]
    data = np.frombuffer(text.lower().encode("utf-8", "replace").translate(_READ), np.uint8)
    found = []
    for start in range(0, max(len(data) - 2, 1), PART):
        codes = _grams(data[start : start + PART + 2])
        order = np.arange(len(codes), dtype=np.int32)
        seen[codes] = order  # the last place of each code stays
        found.append(codes[seen[codes] == order])
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


@dataclass
class Model:
    """What scoring needs: n-grams of the landmarks, their weight for each language, an offset."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def lookup(self) -> np.ndarray:
        places = np.full(SPACE, len(self.codes), np.int32)  # the last row of the padded weights is zero
        places[self.codes] = np.arange(len(self.codes), dtype=np.int32)
        return places


def fit(texts: list[str], languages: list[str], landmarks: int = 192, ridge: float = 0.05) -> Model | None:
    """Fit on labelled texts in the given order; the first ones, language by language in turn, are landmarks."""
    names = sorted(set(languages))
    sets = [presence(t) for t in texts]
    if not names or not any(len(s) for s in sets):
        return None
    turn = {name: 0 for name in names}
    rank = []
    for name in languages:
        rank.append(turn[name])
        turn[name] += 1
    order = sorted((r, name, k) for k, (r, name) in enumerate(zip(rank, languages, strict=True)) if len(sets[k]))
    marks = [k for _, _, k in order[:landmarks]]
    codes = np.unique(np.concatenate([sets[k] for k in marks]))
    present = np.zeros((len(codes) + 1, len(marks)), np.float32)
    for column, k in enumerate(marks):
        present[np.searchsorted(codes, sets[k]), column] = 1 / np.sqrt(len(sets[k]))
    kernel = np.zeros((len(texts), len(marks)))
    for k, found in enumerate(sets):
        at = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
        kernel[k] = present[at[codes[at] == found]].sum(0) / np.sqrt(max(len(found), 1))
    values, vectors = np.linalg.eigh(kernel[marks])
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel @ root
    centre = features.mean(0)
    targets = np.array([[1.0 if name == own else -1.0 for name in names] for own in languages])
    level = targets.mean(0)
    around = features - centre
    gram = around.T @ around + ridge * np.eye(around.shape[1])
    beta = np.linalg.solve(gram, around.T @ (targets - level))
    return Model(names, codes, (present @ (root @ beta)).astype(np.float32), level - centre @ beta)


def predict(model: Model, places: np.ndarray, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Languages and scores of a batch; a text that is null or has no letter is undetermined."""
    read = [k for k, t in enumerate(texts) if t and _LETTER.search(t)]
    names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if read:
        sets = [presence(texts[k]) for k in read]
        sizes = np.array([len(s) for s in sets])
        rows = model.weights[places[np.concatenate(sets)]]
        sums = np.add.reduceat(rows, np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0)
        values = sums / np.sqrt(sizes)[:, None] + model.offset
        best = values.argmax(1)
        level = np.clip((values[np.arange(len(read)), best] + 1) / 2, 0, 1)
        for k, b, v in zip(read, best.tolist(), level.tolist(), strict=True):
            names[k], scores[k] = model.languages[b], v
    return names, scores


def training_sample(df: DataFrame, text: str, label: str, key: str, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label, drawn by a hash of the key: the same rows in every run.

    Counts of labels reach the driver, one row per label. The result has at most
    ``2 * per_label`` rows per label, in the order of the hash.
    """
    rows = df.filter(F.col(text).isNotNull() & F.col(label).isNotNull())
    counts = [(r[0], r[1]) for r in rows.groupBy(label).count().collect()]
    draw = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30))
    share: Column = F.lit(0)
    for name, n in counts:
        share = F.when(F.col(label) == name, min(1 << 30, (per_label << 30) // n * 6 // 5)).otherwise(share)
    drawn = rows.filter(draw < share).select(text, label, F.xxhash64(F.col(key)).alias("draw"))
    return drawn.orderBy("draw", text, label).limit(max(1, 2 * per_label * len(counts)))


def learn(df: DataFrame, text: str, label: str, key: str, per_label: int = 300, landmarks: int = 192) -> Model | None:
    """Fit on a bounded sample of labelled rows: ``per_label`` texts of each language.

    Null texts and labels are left out. Without any labelled text there is no model. The label is cast
    to text.
    """
    labelled = df.select(F.col(text).alias("text"), F.col(label).cast("string").alias("label"), F.col(key).alias("key"))
    sample = training_sample(labelled, "text", "label", "key", per_label).collect()
    return fit([r["text"] for r in sample], [r["label"] for r in sample], landmarks)


def identify(df: DataFrame, model: Model | None) -> DataFrame:
    """Replace ``text`` by ``lang_pred`` and ``score`` (0 to 1); all other columns stay.

    Null texts and texts without a letter are ``und`` with score 0, and so is every text if there is no
    model. Ties go to the language that sorts first. Texts are read whole, a megabyte at a time.
    """
    kept = [c for c in df.columns if c not in ("text", "lang_pred", "score")]
    schema = ", ".join([df.select(*kept)._jdf.schema().toDDL()] * bool(kept) + ["lang_pred string, score double"])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = None
        for batch in pieces(batches):
            texts = batch.column("text").to_pylist()
            found = shared.value
            if found is None:
                names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            else:
                places = found.lookup() if places is None else places
                names, scores = predict(found, places, texts)
            added = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *added], names=[*kept, "lang_pred", "score"])

    return df.select(*kept, "text").mapInArrow(run, schema)
