"""Fill-in-the-middle documents as piece tables.

A document is a list of descriptors (buffer, start, length) over two immutable buffers: its
text and the sentinels. Cutting splits a descriptor, an arrangement permutes the descriptors and
the inverse permutation restores them; no text is copied until an output is written. Hashes read the
descriptors as a stream of bounded slices.

Two cuts between units (lines, or code points) divide a text into prefix, middle and suffix. They and
the form come from the SHA-256 of ``<seed>:<id>``, so reruns and retries agree:

* ``plain`` - the text as it is;
* ``psm`` - ``<P>`` prefix ``<S>`` suffix ``<M>`` middle;
* ``spm`` - ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.

A text that contains a sentinel stays plain: that makes the outputs readable back. No sentinel begins
inside another, so none arises where pieces meet.

Scale: row by row, no shuffle; a task holds one text and one output at a time beside its batch.

Defined cases: a null text is empty; an empty text is plain; a null id counts as an empty one;
repeated ids get the same draws; other columns are ignored; an empty table gives no rows. Bytes
that are no UTF-8 count as one code point each and come back as they were.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The sentinels before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
TEXT, MARKS = 0, 1
SLICE = 1 << 20

#: Descriptors in their own order are prefix, middle, suffix and the three sentinels.
ARRANGEMENTS = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


class PieceTable:
    """A text described by pieces of immutable buffers."""

    def __init__(self, buffers: Sequence[str], pieces: Sequence[Piece]):
        self.buffers, self.pieces = tuple(buffers), list(pieces)

    @classmethod
    def of(cls, text: str) -> PieceTable:
        return cls((text, "".join(SENTINELS)), [Piece(TEXT, 0, len(text))])

    def cut(self, at: int) -> None:
        """Split the descriptor that holds offset ``at``; at a border the later one, so its left part is empty."""
        begin, k = 0, 0
        while k + 1 < len(self.pieces) and begin + self.pieces[k].length <= at:
            begin += self.pieces[k].length
            k += 1
        buffer, start, length = self.pieces[k]
        left = at - begin
        if not 0 <= left <= length:
            raise ValueError(f"no offset {at}")
        self.pieces[k:k + 1] = [Piece(buffer, start, left), Piece(buffer, start + left, length - left)]

    def mark(self) -> None:
        """Add the descriptors of the sentinels."""
        at = 0
        for s in SENTINELS:
            self.pieces.append(Piece(MARKS, at, len(s)))
            at += len(s)

    def arranged(self, order: Sequence[int]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[k] for k in order])

    def stream(self) -> Iterator[str]:
        """The described text in slices of bounded size."""
        for buffer, start, length in self.pieces:
            for at in range(start, start + length, SLICE):
                yield self.buffers[buffer][at:min(at + SLICE, start + length)]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(_bytes(part))
        return digest.hexdigest()


def inverse(order: Sequence[int]) -> list[int]:
    back = [0] * len(order)
    for k, p in enumerate(order):
        back[p] = k
    return back


def _text(data: bytes | None) -> str:
    return (data or b"").decode("utf-8", "surrogateescape")


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogateescape")


def borders(text: str, unit: str) -> Sequence[int]:
    """Offsets between units, 0 and the text's end included."""
    if unit == "char":
        return range(len(text) + 1)
    found, at = [0], text.find("\n")
    while at >= 0:
        found.append(at + 1)
        at = text.find("\n", at + 1)
    if found[-1] < len(text):
        found.append(len(text))
    return found


def draws(seed: int, doc_id: str | None) -> tuple[int, int, int, int]:
    digits = hashlib.sha256(f"{seed}:{doc_id or ''}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * k:8 * k + 8], 16) for k in range(4))
    return h1, h2, h3, h4


def transform(text: str, drawn: tuple[int, int, int, int], *, rate: int, spm: int, unit: str) -> tuple[int, str, PieceTable]:
    """(number of units, form, pieces of the output)."""
    h1, h2, h3, h4 = drawn
    table, at = PieceTable.of(text), borders(text, unit)
    n = len(at) - 1
    if not text or h3 % 100 >= rate or any(s in text for s in SENTINELS):
        return n, "plain", table
    form = "spm" if h4 % 100 < spm else "psm"
    for k in sorted((h1 % (n + 1), h2 % (n + 1))):
        table.cut(at[k])
    table.mark()
    return n, form, table.arranged(ARRANGEMENTS[form])


def described(output: str, form: str) -> PieceTable:
    """The pieces of the text that an output was made from, over the output itself."""
    if form == "plain":
        return PieceTable((output,), [Piece(TEXT, 0, len(output))])
    order = ARRANGEMENTS[form]
    pieces, at = [], 0
    marks = [SENTINELS[k - 3] for k in order[::2]]
    for mark, following in zip(marks, [*marks[1:], None]):
        if output[at:at + len(mark)] != mark:
            raise ValueError(f"no {mark} at {at}")
        pieces.append(Piece(TEXT, at, len(mark)))
        at += len(mark)
        end = output.index(following, at) if following else len(output)
        pieces.append(Piece(TEXT, at, end - at))
        at = end
    restored = PieceTable((output,), pieces).arranged(inverse(order))
    return PieceTable((output,), restored.pieces[:3])


_PIECE = pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())])
_MADE = pa.schema([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                   ("pieces", pa.list_(_PIECE)), ("output", pa.binary()), ("output_sha256", pa.string())])
_MADE_SQL = ("n bigint, form string, prefix_chars bigint, middle_chars bigint, "
             "pieces array<struct<buffer:int,start:bigint,length:bigint>>, output binary, output_sha256 string")
HELD_BYTES = 8_000_000


def _batches(ids: pa.Array, rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of a bounded number of bytes, each row behind its id."""
    schema = pa.schema([pa.field("id", ids.type), *schema])
    held, size, first = [], 0, 0

    def batch() -> pa.RecordBatch:
        own = [ids.slice(first, len(held)), *(pa.array(c, f.type) for c, f in zip(zip(*held), list(schema)[1:]))]
        return pa.RecordBatch.from_arrays(own, schema=schema)

    for row in rows:
        held.append(row)
        size += 200 + sum(len(x) for x in row if isinstance(x, bytes))
        if size >= HELD_BYTES:
            yield batch()
            first, held, size = first + len(held), [], 0
    if held:
        yield batch()


def fill_middle(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, rate: int = 100,
                spm: int = 50, unit: str = "line") -> DataFrame:
    """``id_col``, ``n`` units, ``form``, ``prefix_chars`` and ``middle_chars`` (null if plain), the output's
    ``pieces``, ``output`` and ``output_sha256``, one row per document.

    ``rate`` percent of the texts are rearranged, ``spm`` percent of these with the suffix first.
    """
    if unit not in ("line", "char"):
        raise ValueError("unit must be line or char")
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{id_col}`").cast("string").alias("name"),
                      F.col(f"`{text_col}`").cast("string").cast("binary").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for name, data in zip(batch.column(1), batch.column(2)):
                n, form, table = transform(_text(data.as_py()), draws(seed, name.as_py()), rate=rate, spm=spm, unit=unit)
                own = [None, None] if form == "plain" else [
                    table.pieces[k].length for k in inverse(ARRANGEMENTS[form])[:2]]
                yield (n, form, *own, [p._asdict() for p in table.pieces], b"".join(map(_bytes, table.stream())),
                       table.sha256())

        for batch in batches:
            yield from _batches(batch.column(0), rows(batch), _MADE)

    made = own.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, {_MADE_SQL}")
    return made.select(F.col("id").alias(id_col), "n", "form", "prefix_chars", "middle_chars", "pieces",
                       F.col("output").cast("string").alias("output"), "output_sha256")


def restore(made: DataFrame, *, id_col: str = "doc_id", output_col: str = "output", form_col: str = "form",
            carry: Sequence[str] = ()) -> DataFrame:
    """``id_col``, ``carry``, ``text`` and ``restored_sha256``: the texts rebuilt from outputs and forms alone."""
    packed = F.struct(F.col(f"`{id_col}`").alias("id"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(carry)])
    own = made.select(packed.alias("id"), F.col(f"`{output_col}`").cast("binary").alias("data"),
                      F.col(f"`{form_col}`").alias("form"))
    back = pa.schema([("text", pa.binary()), ("restored_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for data, form in zip(batch.column(1), batch.column(2)):
                table = described(_text(data.as_py()), form.as_py())
                yield b"".join(map(_bytes, table.stream())), table.sha256()

        for batch in batches:
            yield from _batches(batch.column(0), rows(batch), back)

    out = own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, text binary, restored_sha256 string")
    return out.select(F.col("id.id").alias(id_col), *[F.col(f"id.c{k}").alias(c) for k, c in enumerate(carry)],
                      F.col("text").cast("string").alias("text"), "restored_sha256")
