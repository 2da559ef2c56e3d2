"""Byte-level BPE encoding and decoding with the tokenizers library.

The library merges characters, not bytes: every byte is shown as one printable character, the
ranks of byte sequences become merges of such character strings, and decoding maps the
characters back. A token may hold part of a character; decoding joins bytes first and reads
UTF-8 afterwards, so split characters come back whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from forecourt.llm.tokens import pieces

ENCODE_BYTES = 1 << 18


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, lines))}


def merges(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """All pairs of tokens whose join is a token, by the rank of the join."""
    out = []
    for token, _ in sorted(ranks.items(), key=lambda item: item[1]):
        cuts = [(token[:k], token[k:]) for k in range(1, len(token))]
        out += [pair for pair in cuts if pair[0] in ranks and pair[1] in ranks]
    return out


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str):
    """A tokenizer that follows the ranks: a whole piece that is a token stays one."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, shown = read_ranks(path), byte_characters()
    show = lambda token: "".join(shown[b] for b in token)
    model = models.BPE(
        vocab={show(token): rank for token, rank in ranks.items()},
        merges=[(show(a), show(b)) for a, b in merges(ranks)],
        ignore_merges=True,
        cache_capacity=0,  # the library's cache of words costs more than merging them anew
    )
    found = Tokenizer(model)
    found.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return found


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """Bytes of each id, through the reversed byte table."""
    table = {c: b for b, c in enumerate(byte_characters())}
    shown = byte_characters()
    ranks = read_ranks(path)
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = bytes(table[c] for c in "".join(shown[b] for b in token))
    return out


def decode_ids(ids, path: str) -> bytes:
    """Bytes of a sequence of ids. An unknown id is an error."""
    return b"".join(map(token_bytes(path).__getitem__, ids))


def encode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Add ``ids``, and ``starts`` and ``ends``, the character span of each token in the text.

    The tokens of one character that is split all have that character's span. Null and empty texts
    have empty lists. Columns of these names are replaced. Texts are encoded whole, several at a time
    up to a quarter of a megabyte; a longer text is a batch of its own.
    """
    df = df.drop("ids", "starts", "ends")
    schema = f"{df._jdf.schema().toDDL()}, ids array<int>, starts array<int>, ends array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path, pattern)
        for batch in pieces(batches, ENCODE_BYTES):
            coded = coder.encode_batch([t or "" for t in batch.column("text").to_pylist()], add_special_tokens=False)
            lists = ([c.ids for c in coded], [[o[0] for o in c.offsets] for c in coded], [[o[1] for o in c.offsets] for c in coded])
            added = [pa.array(x, pa.list_(pa.int32())) for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "ids", "starts", "ends"])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str) -> DataFrame:
    """Add ``decoded``, the text that ``ids`` stand for; null for null. Bytes that aren't UTF-8 are replaced."""
    df = df.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if ids is None else decode_ids(ids, path).decode("utf-8", "replace")
                for ids in batch.column("ids").to_pylist()
            ]
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    return df.mapInArrow(run, f"{df._jdf.schema().toDDL()}, decoded string")


def round_trip(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every text and decode its ids again: adds ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    The hash of the ids is taken over little-endian unsigned 32-bit integers. Both directions run on the
    same batch, so ids never leave the task. Null texts count as empty.
    """
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    kept = [c for c in df.columns if c not in (*names, "text")]
    schema = ", ".join([df.select(*kept)._jdf.schema().toDDL()] * bool(kept) + ["n_tokens bigint, ids_sha256 string, decoded_sha256 string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path, pattern)
        for batch in pieces(batches, ENCODE_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = [c.ids for c in coder.encode_batch_fast(texts, add_special_tokens=False)]
            found = (
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(decode_ids(x, path)).hexdigest() for x in ids], pa.string()),
            )
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *found], names=[*kept, *names])

    return df.select(*kept, "text").mapInArrow(run, schema)
