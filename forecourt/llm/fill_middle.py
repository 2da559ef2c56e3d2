"""Fill-in-the-middle: texts cut in three, the parts put in another order around markers.

A text is a row of units, each a word with the white space before it. Two numbers drawn from the
document's id cut it into prefix, middle and suffix. The bytes of a whole batch move at once: each part is
shifted by one amount, so a difference array that is non-zero only where parts begin gives, summed up, the
shift of every byte, and numpy scatters all bytes to their new places. Going back, the markers in the
output tell where the parts lie, and the bytes are gathered from there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import fresh
from forecourt.llm.tokens import WHITE, pieces

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3  # bytes of a marker
BLOCK = 1 << 20
ADDED = ("n_units", "form", "prefix_chars", "middle_chars", "output")

_WHITE = np.zeros(256, bool)
_WHITE[list(WHITE)] = True


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the id in decimal; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text begins (one more entry at the end)."""
    column = pa.compute.fill_null(column.cast(pa.binary()), b"")
    places, data = column.buffers()[1:]
    origin = np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[origin[0] : origin[-1]], origin - origin[0]


def texts(data: np.ndarray, origin: np.ndarray) -> pa.Array:
    """A text column from its bytes and the places where texts begin."""
    return pa.StringArray.from_buffers(len(origin) - 1, pa.py_buffer(origin.astype(np.int32)), pa.py_buffer(data))


def unit_ends(data: np.ndarray, origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units end, and the place in that list of each text's first unit (one more at the end)."""
    white = _WHITE[data]
    stop = ~white
    stop[:-1] &= white[1:]
    last = origin[1:][np.diff(origin) > 0] - 1
    stop[last] = True  # white space at the end of a text is a unit as well
    ends = np.flatnonzero(stop) + 1
    return ends, np.searchsorted(ends, origin, side="right")


def characters(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Code points between byte places: the bytes that don't continue a character."""
    return np.array([np.count_nonzero((data[a:b] & 0xC0) != 0x80) for a, b in zip(start, end, strict=True)], np.int64)


def shifts(start: np.ndarray, shift: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """The shift of every byte, block by block. Part k begins at ``start[k]`` (ascending) and moves by ``shift[k]``."""
    change = np.diff(shift, prepend=0)
    moved = 0
    for low in range(0, size, BLOCK):
        high = min(low + BLOCK, size)
        a, b = np.searchsorted(start, (low, high))
        difference = np.zeros(high - low, np.int64)
        np.add.at(difference, start[a:b] - low, change[a:b])
        difference[0] += moved
        np.cumsum(difference, out=difference)
        moved = int(difference[-1])
        yield low, high, difference


def arranged(origin: np.ndarray, first: np.ndarray, second: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where outputs begin, and in them: prefix, middle and suffix of every text.

    ``first`` and ``second`` are the places of the cuts; ``form`` is 0 for plain, 1 for psm, 2 for spm.
    """
    size = np.diff(origin) + np.where(form > 0, 3 * MARK, 0)
    out = np.concatenate(([0], np.cumsum(size)))
    head, tail = first - origin[:-1], origin[1:] - second
    plain = form == 0
    prefix = out[:-1] + np.where(plain, 0, np.where(form == 1, MARK, 2 * MARK + tail))
    suffix = out[:-1] + np.where(plain, second - origin[:-1], np.where(form == 1, 2 * MARK + head, MARK))
    middle = out[:-1] + np.where(plain, head, 3 * MARK + head + tail)
    return out, prefix, middle, suffix


def scattered(data: np.ndarray, origin: np.ndarray, first: np.ndarray, second: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all outputs and where each begins."""
    out, prefix, middle, suffix = arranged(origin, first, second, form)
    begin = np.stack([origin[:-1], first, second], 1).ravel()
    place = np.stack([prefix, middle, suffix], 1).ravel()
    found = np.empty(int(out[-1]), np.uint8)
    for low, high, shift in shifts(begin, place - begin, len(data)):
        found[np.arange(low, high) + shift] = data[low:high]
    cut = form > 0
    for mark, part in ((PREFIX, prefix), (MIDDLE, middle), (SUFFIX, suffix)):
        found[part[cut, None] - MARK + np.arange(MARK)] = np.frombuffer(mark, np.uint8)
    return found, out


def marks(data: np.ndarray, owner: np.ndarray, origin: np.ndarray, mark: bytes) -> np.ndarray:
    """The place of a marker in each of the texts ``owner``; it must be there exactly once."""
    found = np.ones(max(len(data) - MARK + 1, 0), bool)
    for k, byte in enumerate(mark):
        found &= data[k : len(data) - MARK + 1 + k] == byte
    at = np.flatnonzero(found)
    text = np.searchsorted(origin, at, side="right") - 1
    own = (at + MARK <= origin[text + 1]) & np.isin(text, owner)
    if not np.array_equal(text[own], owner):
        raise ValueError(f"a transformed text must hold {mark.decode()} exactly once")
    return at[own]


def gathered(data: np.ndarray, origin: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts that outputs were made of, and where each begins."""
    owner = np.flatnonzero(form > 0)
    size = np.diff(origin) - np.where(form > 0, 3 * MARK, 0)
    out = np.concatenate(([0], np.cumsum(size)))
    p, s, m = (marks(data, owner, origin, mark) for mark in (PREFIX, SUFFIX, MIDDLE))
    psm = form[owner] == 1
    # a plain text is one part: its prefix reaches to its end
    from_prefix, from_middle, from_suffix = origin[:-1].copy(), origin[1:].copy(), origin[1:].copy()
    from_prefix[owner], from_middle[owner], from_suffix[owner] = p + MARK, m + MARK, s + MARK
    head, tail = size.copy(), np.zeros(len(size), np.int64)
    head[owner] = np.where(psm, s, m) - p - MARK
    tail[owner] = np.where(psm, m, p) - s - MARK
    begin = np.stack([out[:-1], out[:-1] + head, out[1:] - tail], 1).ravel()
    place = np.stack([from_prefix, from_middle, from_suffix], 1).ravel()
    found = np.empty(int(out[-1]), np.uint8)
    for low, high, shift in shifts(begin, place - begin, len(found)):
        found[low:high] = data[np.arange(low, high) + shift]
    return found, out


_FORMS = ("plain", "psm", "spm")


def _numbers(column: pa.Array) -> np.ndarray:
    return np.array([_FORMS.index(f) for f in column.to_pylist()], np.int64)


def transform(df: DataFrame, doc_id: str = "doc_id", seed: int = 42, plain: int = 50, spm: int = 80) -> DataFrame:
    """Add ``n_units``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` to a table with ``text``.

    Of a hundred texts ``plain`` stay as they are, and ``spm`` of a hundred others put the suffix first. Null and
    empty texts, and texts that already hold a marker, are plain; the output of a null text is empty. Repeated
    rows and rows with one id are cut by the same draws. Columns with the names of added ones are replaced. Texts are
    read whole; beside a text, its output and one number per unit, memory is bounded by a block.
    """
    df = df.drop(*(c for c in ADDED if c not in (doc_id, "text")))
    h = draws(F.col(doc_id), seed)
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = F.contains(text, F.lit(PREFIX.decode())) | F.contains(text, F.lit(SUFFIX.decode())) | F.contains(text, F.lit(MIDDLE.decode()))
    form = F.when((text == "") | marked | (h[2] % 100 >= plain), "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    one, two = fresh(df, "draw1", "draw2")
    drawn = df.select("*", form.alias("form"), h[0].alias(one), h[1].alias(two))
    schema = f"{df._jdf.schema().toDDL()}, n_units bigint, form string, prefix_chars bigint, middle_chars bigint, output string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, origin = buffers(batch.column("text"))
            ends, first = unit_ends(data, origin)
            n = np.diff(first)
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) % (n + 1) for c in (one, two))
            bounds = np.concatenate(([0], ends))
            cuts = [np.where(k > 0, bounds[first[:-1] + k], origin[:-1]) for k in (np.minimum(a, b), np.maximum(a, b))]
            form = _numbers(batch.column("form"))
            output = texts(*scattered(data, origin, *cuts, form))
            chars = [pa.array(characters(data, x, y), pa.int64(), mask=form == 0) for x, y in ((origin[:-1], cuts[0]), cuts)]
            kept = [batch.column(c) for c in batch.schema.names if c not in ("form", one, two)]
            names = [c for c in batch.schema.names if c not in ("form", one, two)]
            columns = [*kept, pa.array(n, pa.int64()), batch.column("form"), *chars, output]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *ADDED])

    return drawn.mapInArrow(run, schema)


def restore(df: DataFrame) -> DataFrame:
    """Add ``restored``, the text that ``output`` was made of, told from ``output`` and ``form`` alone.

    A null output counts as an empty text. An output whose form isn't plain must hold each marker once, and an unknown form is
    an error. A column ``restored`` is replaced.
    """
    df = df.drop("restored")
    schema = f"{df._jdf.schema().toDDL()}, restored string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in pieces(iter([pa.RecordBatch.from_arrays([batch.column("output")], names=["text"])])):
                rows = batch.slice(at, part.num_rows)
                at += part.num_rows
                found = gathered(*buffers(part.column("text")), _numbers(rows.column("form")))
                yield rows.append_column("restored", texts(*found))

    return df.mapInArrow(run, schema)
