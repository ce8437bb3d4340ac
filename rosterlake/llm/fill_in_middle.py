"""Fill-in-middle by piece tables: documents rearranged for infilling, and put back together.

A document is a row of descriptors (buffer, start, length) over two buffers that never change, the
text in UTF-8 and the sentinels. Cutting splits descriptors, an arrangement permutes them, the
inverse permutation restores the document, and digests run over the descriptors: no text is copied
or joined on the way.

Cuts lie between units: a run of the letters A to Z in either case, or any other character. Units
are found in windows of bytes, so a text costs little more memory than its bytes.

Null is the empty text. A text that is empty or holds a sentinel stays plain, since an output with
further sentinels could not be read back. Rows are independent: repeated rows give equal results,
a missing id counts as no digits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

PLAIN, PSM, SPM = "plain", "psm", "spm"
# Bytes whose units are counted at a time.
WINDOW = 1 << 20

# Descriptors of a cut document in the order of the text, each part behind its sentinel.
_PARTS = ("prefix", "middle", "suffix")
# Places of these six descriptors in the output.
ORDERS = {PSM: (0, 1, 4, 5, 2, 3), SPM: (4, 5, 0, 1, 2, 3)}

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True


@dataclass(frozen=True)
class Sentinels:
    """Marks before the parts. None may begin with an end of another."""

    prefix: str = "<P>"
    middle: str = "<M>"
    suffix: str = "<S>"

    def encoded(self) -> list[bytes]:
        return [getattr(self, part).encode() for part in _PARTS]


@dataclass(frozen=True)
class Piece:
    """A descriptor: some bytes of a buffer."""

    buffer: int
    start: int
    length: int


class PieceTable:
    """A text as descriptors over buffers that never change."""

    def __init__(self, buffers: Sequence, pieces: Sequence[Piece]):
        self.buffers = [memoryview(buffer) for buffer in buffers]
        self.pieces = list(pieces)

    def cut(self, at: int) -> None:
        """Split the descriptor around byte ``at``; a cut at an edge leaves an empty one."""
        for i, piece in enumerate(self.pieces):
            if at <= piece.length:
                rest = replace(piece, start=piece.start + at, length=piece.length - at)
                self.pieces[i : i + 1] = [replace(piece, length=at), rest]
                return
            at -= piece.length
        raise IndexError("cut beyond the end")

    def permuted(self, order: Sequence[int]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[i] for i in order])

    def chunks(self) -> Iterator[memoryview]:
        for piece in self.pieces:
            yield self.buffers[piece.buffer][piece.start : piece.start + piece.length]

    def digest(self) -> str:
        """SHA-256 of the text as lowercase hex."""
        found = hashlib.sha256()
        for chunk in self.chunks():
            found.update(chunk)
        return found.hexdigest()

    def joined(self) -> bytes:
        return b"".join(self.chunks())


def inverse(order: Sequence[int]) -> list[int]:
    """The permutation that undoes ``order``."""
    return sorted(range(len(order)), key=order.__getitem__)


# --- units -------------------------------------------------------------------


def _unit_starts(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, whether a unit starts at each byte) of one window after the other."""
    after_letter = False
    for begin in range(0, len(data), WINDOW):
        window = data[begin : begin + WINDOW]
        letter = _LETTER[window]
        inside = np.empty(len(window), dtype=bool)
        inside[0] = after_letter and letter[0]
        np.logical_and(letter[1:], letter[:-1], out=inside[1:])
        # bytes 10xxxxxx go on with a character
        yield begin, ((window & 0xC0) != 0x80) & ~inside
        after_letter = letter[-1]


class Units:
    """Where the units of a text in UTF-8 begin."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.counts = [int(np.count_nonzero(starts)) for _, starts in _unit_starts(data)]
        self.n = sum(self.counts)

    def offset(self, unit: int) -> int:
        """The first byte of a unit; the end of the text for the number of units."""
        before = 0
        for (begin, starts), count in zip(_unit_starts(self.data), self.counts):
            if unit < before + count:
                return begin + int(np.flatnonzero(starts)[unit - before])
            before += count
        return len(self.data)


def _code_points(data: np.ndarray) -> int:
    windows = (data[i : i + WINDOW] for i in range(0, len(data), WINDOW))
    return sum(int(np.count_nonzero((window & 0xC0) != 0x80)) for window in windows)


# --- documents ---------------------------------------------------------------


@dataclass(frozen=True)
class Rates:
    """Of a hundred documents, those that stay plain; of a hundred others, those in suffix order."""

    plain_from: int = 90
    spm_below: int = 20


@dataclass
class Arranged:
    """A document in its form, as descriptors."""

    table: PieceTable
    form: str
    n: int
    prefix_chars: int | None = None
    middle_chars: int | None = None


def arrange(
    text, draws: Sequence[int], sentinels: Sentinels = Sentinels(), rates: Rates = Rates()
) -> Arranged:
    """Cut and rearrange a text (bytes or a buffer of UTF-8) as four whole numbers say.

    The first two choose the cuts among the places before, between and after units, the third
    whether the document stays plain, the fourth its order.
    """
    data = np.frombuffer(text, dtype=np.uint8) if len(text) else np.empty(0, dtype=np.uint8)
    units = Units(data)
    marks = sentinels.encoded()
    table = PieceTable([text, b"".join(marks)], [Piece(0, 0, len(data))])
    has_mark = re.search(b"|".join(map(re.escape, marks)), text)
    if not units.n or has_mark or draws[2] % 100 >= rates.plain_from:
        return Arranged(table, PLAIN, units.n)
    first, last = sorted(draw % (units.n + 1) for draw in draws[:2])
    first, last = units.offset(first), units.offset(last)
    table.cut(last)
    table.cut(first)
    for i, mark in enumerate(marks):
        table.pieces.insert(2 * i, Piece(1, sum(map(len, marks[:i])), len(mark)))
    form = SPM if draws[3] % 100 < rates.spm_below else PSM
    return Arranged(
        table.permuted(ORDERS[form]),
        form,
        units.n,
        _code_points(data[:first]),
        _code_points(data[first:last]),
    )


def restore(output, form: str, sentinels: Sentinels = Sentinels()) -> PieceTable:
    """The document, as descriptors over an output (bytes or a buffer) in the given form."""
    table = PieceTable([output], [Piece(0, 0, len(output))])
    if form == PLAIN:
        return table
    order, marks = ORDERS[form], sentinels.encoded()
    begin = 0
    edges = []
    for mark in (marks[i // 2] for i in order if i % 2 == 0):
        found = re.compile(re.escape(mark)).search(output, begin)
        if found is None:
            raise ValueError(f"an output of form {form} lacks {mark!r}")
        edges += found.span()
        begin = found.end()
    for at in reversed(edges[1:]):  # the first mark opens the output
        table.cut(at)
    in_text_order = table.permuted(inverse(order))
    return PieceTable(table.buffers, in_text_order.pieces[1::2])


# --- columns -----------------------------------------------------------------


def draws_of(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four numbers from 0 to 2^32 - 1 that depend on the seed and the id only."""
    digits = F.coalesce(doc_id.cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), digits), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


_COUNTS = [
    ("n", pa.int64()),
    ("form", pa.string()),
    ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()),
]
_OUTPUT = pa.struct([*_COUNTS, ("output", pa.string())])
_DIGESTS = pa.struct([*_COUNTS, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
_SQL_COUNTS = "n long, form string, prefix_chars long, middle_chars long"


def _buffers(column: pa.Array) -> Iterator:
    for text in column:
        yield text.as_buffer() if text.is_valid else b""


def _arranged(text: pa.Array, draws: Sequence[pa.Array], sentinels, rates) -> Iterator[Arranged]:
    rows = zip(*(column.to_pylist() for column in draws))
    for buffer, row in zip(_buffers(text), rows):
        yield arrange(buffer, row, sentinels, rates)


def _counts(row: Arranged) -> dict:
    return {
        "n": row.n,
        "form": row.form,
        "prefix_chars": row.prefix_chars,
        "middle_chars": row.middle_chars,
    }


def fill_in_middle(sentinels: Sentinels = Sentinels(), rates: Rates = Rates()):
    """A function from a text column and four columns of draws to a struct of ``n`` (units),
    ``form``, ``prefix_chars``, ``middle_chars`` (code points, null if plain) and ``output``."""

    @arrow_udf(f"struct<{_SQL_COUNTS}, output string>")
    def run(text: pa.Array, a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        rows = [
            _counts(row) | {"output": row.table.joined().decode()}
            for row in _arranged(text, (a, b, c, d), sentinels, rates)
        ]
        return pa.array(rows, _OUTPUT)

    return run


def restored_text(sentinels: Sentinels = Sentinels()):
    """A function from columns of outputs and forms to the documents; null stays null."""

    @arrow_udf("string")
    def run(output: pa.Array, form: pa.Array) -> pa.Array:
        rows = [
            restore(text.as_buffer(), kind, sentinels).joined().decode() if text.is_valid else None
            for text, kind in zip(output, form.to_pylist())
        ]
        return pa.array(rows, pa.string())

    return run


def digests(sentinels: Sentinels = Sentinels(), rates: Rates = Rates()):
    """As ``fill_in_middle``, with digests (SHA-256, lowercase hex) of the output and of the
    document rebuilt from output and form in place of the output itself."""

    @arrow_udf(f"struct<{_SQL_COUNTS}, output_sha256 string, restored_sha256 string>")
    def run(text: pa.Array, a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        rows = []
        for row in _arranged(text, (a, b, c, d), sentinels, rates):
            rebuilt = restore(row.table.joined(), row.form, sentinels)
            shas = {"output_sha256": row.table.digest(), "restored_sha256": rebuilt.digest()}
            rows.append(_counts(row) | shas)
        return pa.array(rows, _DIGESTS)

    return run
