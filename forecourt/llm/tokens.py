"""Words and n-grams of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes that are not separators. Its hash is a polynomial over the
UTF-8 bytes, finished by a mixing step, so equal words have equal hashes in every task
and on every machine. With 64 bits, ten billion different words or n-grams are expected
to collide three times. Nothing here knows Spark; the operators call it per Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute

WHITE = b" \t\n\x0b\x0c\r"
BATCH_BYTES = 1 << 20

_U = np.uint64
_FACTOR = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        steps = np.full(max(n, BATCH_BYTES + 4096), _FACTOR if kind == "up" else _INVERSE)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return _powers[kind][:n]


class Alphabet:
    """Which bytes separate words, and what each byte is read as."""

    def __init__(self, separators: bytes = WHITE, lower: bool = False):
        self.breaks = np.zeros(256, bool)
        self.breaks[list(separators)] = True
        codes = np.arange(256)
        if lower:
            codes[65:91] += 32
        self.values = _BYTES[codes]


PLAIN = Alphabet()
LOWER = Alphabet(lower=True)
ALNUM = Alphabet(bytes(b for b in range(128) if not chr(b).isalnum()), lower=True)
LETTERS = Alphabet(bytes(b for b in range(128) if not chr(b).isalpha()), lower=True)


@dataclass
class Words:
    """The words of some texts in order: hash, number of the text, byte span in its text."""

    hash: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # place of each text's first word; one more entry at the end

    def ngrams(self, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words within a text, and where each begins."""
        last = len(self.hash) - n + 1
        if last <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.text[:last] == self.text[n - 1 :])
        return combine([self.hash[at + k] for k in range(n)], seed), at


def combine(parts: list[np.ndarray], seed: int = 0) -> np.ndarray:
    """One hash for several, sensitive to their order."""
    total = parts[0] + _U(seed)
    for part in parts[1:]:
        total = mix(total) * _FACTOR + part
    return mix(total)


def words(texts: list[bytes], alphabet: Alphabet = PLAIN) -> Words:
    """Words of each text; a text without words has none."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    origin = np.concatenate(([0], np.cumsum(sizes)))
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8) if texts else np.zeros(0, np.uint8)
    broken = np.ones(len(data) + 2, bool)
    broken[1:-1] = alphabet.breaks[data]
    broken[origin[1:]] = True
    edge = np.flatnonzero(broken[1:] != broken[:-1])
    start, end = edge[0::2], edge[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(alphabet.values[data] * _power("up", len(data)), out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * _power("down", len(data) + 1)[start])
    first = np.searchsorted(start, origin)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(hashes, text, start - origin[text], end - origin[text], first)


def encoded(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; a null is an empty text."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], size: int = BATCH_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, or of another column. A longer text is a batch of its own."""
    for batch in batches:
        sizes = np.array([0 if n is None else n for n in pa.compute.binary_length(batch.column(column)).to_pylist()])
        at = 0
        while at < len(sizes):
            n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), size, side="right")))
            yield batch.slice(at, n)
            at += n


def segments(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of true flags as half-open ranges."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    yield from zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True)


def packed(hashes: np.ndarray) -> bytes:
    """Hashes as bytes, for a binary column."""
    return hashes.astype("<u8").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")
