"""Bounded-space online packing of token ids into sequences.

Each task packs its documents as they come, with a fixed number of open windows: what is left
of a document after its full windows goes to the window that it fills best. Where it fits
none, the fullest window is filled up with its beginning and emitted, and the rest looks for a
place again. The windows still open at the end of a task are leftovers: they are packed in the
same way in ever fewer tasks, and the very last ones become sequences whose lengths are powers
of two, which need no padding.
"""

from __future__ import annotations

import functools
import json
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm import pretokens
from rosterlake.llm.scratch import store

CAPACITY = 4096
OPEN_WINDOWS = 32
# Tasks whose leftovers, at most OPEN_WINDOWS x CAPACITY ids each, meet in one task.
MERGED_AT_ONCE = 16
# Words and pieces of words a worker remembers at least (at most twice as many), and the longest
# of them: together some 250 MB at most.
WORD_ENTRIES, PIECE_ENTRIES, MAX_KEY = 400_000, 300_000, 32
# Rows of an Arrow batch that a task hands over.
_ROWS = 8192

_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.binary()),
    ]
)
PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)


class WordIds:
    """The ids of texts by the library and a tokenizer file that drops white space, remembered
    word by word. Texts of other than plain characters go to the library whole."""

    def __init__(self, path: str):
        self.library = pretokens.load(path)
        self.specials = pretokens.special_strings(self.library)
        steps = json.loads(self.library.to_str())["pre_tokenizer"]["pretokenizers"]
        self.pieces = regex.compile(steps[0]["pattern"]["Regex"])
        self.known = pretokens.Remembered(self._piece, PIECE_ENTRIES, MAX_KEY)
        self.words = pretokens.Remembered(self._word, WORD_ENTRIES, MAX_KEY)

    def _piece(self, piece: str) -> bytes:
        if not (piece.isascii() and piece.isprintable()):  # those letters stand for themselves
            piece = piece.encode().decode("latin-1").translate(pretokens.BYTE_LETTERS)
        ids = [token.id for token in self.library.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        if word.isalpha():
            return self.known[word]
        return b"".join(map(self.known.__getitem__, self.pieces.findall(word)))

    def packed(self, text: str) -> bytes:
        """The ids of the whole text as little-endian 32-bit integers."""
        if not pretokens.is_plain(text) or (self.specials and self.specials.search(text)):
            ids = self.library.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        look_up = self.words.__getitem__
        return b"".join(
            [b"".join(map(look_up, part.lower().split())) for part in pretokens.slices(text)]
        )


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per worker and file."""
    return WordIds(path)


@dataclass(slots=True)
class Piece:
    """Consecutive ids of one document; ``ids`` holds four bytes for each."""

    doc_id: int | None
    start: int
    ids: memoryview
    doc_tokens: int

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, length: int) -> tuple[Piece, Piece]:
        at = 4 * length
        return (
            Piece(self.doc_id, self.start, self.ids[:at], self.doc_tokens),
            Piece(self.doc_id, self.start + length, self.ids[at:], self.doc_tokens),
        )


class Packer:
    """Open windows of one task; gives the windows that are full."""

    def __init__(self, capacity: int = CAPACITY, windows: int = OPEN_WINDOWS):
        self.capacity, self.limit = capacity, windows
        self.windows: list[list[Piece]] = []
        self.room: list[int] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece) >= self.capacity:
            full, piece = piece.cut(self.capacity)
            yield [full]
        while len(piece):
            length = len(piece)
            # best fit: the window that keeps the least room
            fitting = [(room, k) for k, room in enumerate(self.room) if room >= length]
            if fitting:
                k = min(fitting)[1]
            elif len(self.windows) < self.limit:
                k = len(self.windows)
                self.windows.append([])
                self.room.append(self.capacity)
            else:
                k = self.room.index(min(self.room))
            first, piece = piece.cut(min(length, self.room[k]))
            self.windows[k].append(first)
            self.room[k] -= len(first)
            if not self.room[k]:
                yield self.windows.pop(k)
                self.room.pop(k)

    def leftovers(self) -> list[Piece]:
        """The pieces of the open windows, window by window, the fullest first."""
        order = sorted(range(len(self.windows)), key=lambda k: (self.room[k], k))
        return [piece for k in order for piece in self.windows[k]]


def without_padding(pieces: list[Piece], capacity: int) -> Iterator[list[Piece]]:
    """The pieces as sequences of ``capacity`` and, at the end, of falling powers of two."""
    left = sum(map(len, pieces))
    sequence: list[Piece] = []
    room = 0
    for piece in pieces:
        while len(piece):
            if not room:
                room = capacity if left >= capacity else 1 << (left.bit_length() - 1)
            first, piece = piece.cut(min(len(piece), room))
            sequence.append(first)
            room -= len(first)
            left -= len(first)
            if not room:
                yield sequence
                sequence = []


def _rows(pieces: Iterable[Piece], sequence: int | None) -> Iterator[tuple]:
    offset = 0
    for p in pieces:
        placed = sequence is not None
        yield (
            p.doc_id,
            p.start,
            len(p),
            zlib.crc32(p.ids),
            p.doc_tokens,
            sequence,
            offset if placed else None,
            None if placed else bytes(p.ids),
        )
        offset += len(p)


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []
    for row in rows:
        waiting.append(row)
        if len(waiting) >= _ROWS:
            yield _batch(waiting)
            waiting = []
    if waiting:
        yield _batch(waiting)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, field.type) for c, field in zip(columns, _PIECE, strict=True)], schema=_PIECE
    )


def _pack(
    pieces: Callable[[pa.RecordBatch], Iterator[Piece]],
    level: int,
    last: bool,
    capacity: int,
    windows: int,
):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (level << 24 | TaskContext.get().partitionId()) << 32
        packer = Packer(capacity, windows)

        def rows() -> Iterator[tuple]:
            nonlocal number
            for batch in batches:
                for piece in pieces(batch):
                    for full in packer.add(piece):
                        yield from _rows(full, number)
                        number += 1
            if last:
                for sequence in without_padding(packer.leftovers(), capacity):
                    yield from _rows(sequence, number)
                    number += 1
            else:
                yield from _rows(packer.leftovers(), None)

        return _batches(rows())

    return run


def _documents(path: str, end_id: int):
    end = end_id.to_bytes(4, "little")

    def pieces(batch: pa.RecordBatch) -> Iterator[Piece]:
        encoder = word_ids(path)
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            ids = encoder.packed(text.as_py() or "") + end
            yield Piece(doc_id.as_py(), 0, memoryview(ids), len(ids) // 4)

    return pieces


def _stored(batch: pa.RecordBatch) -> Iterator[Piece]:
    for row in batch.to_pylist():
        yield Piece(row["doc_id"], row["start"], memoryview(row["ids"]), row["doc_tokens"])


def pack(
    docs: DataFrame,
    path: str,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """Pieces of all documents in sequences of ``capacity`` ids.

    A document's ids are those of the tokenizer file ``path`` (of the word kind) and ``end_id``.
    Result: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; ``ids_crc32`` is
    taken over the piece's ids as little-endian 32-bit integers. Every sequence is full but the
    last ones of the whole table, whose lengths are falling powers of two.

    A null text is an empty one and has ``end_id`` alone. Rows with a null or repeated id are
    documents of their own. No documents give no pieces. Other columns are not looked at.
    ``capacity`` must be a power of two.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    rows = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    tasks = rows.rdd.getNumPartitions()
    level, make = 0, _documents(path, end_id)
    finished: list[DataFrame] = []
    while True:
        last = tasks <= 1
        packed = rows.mapInArrow(_pack(make, level, last, capacity, windows), PIECE)
        if last:
            finished.append(packed)
            break
        packed = store(packed, f"pieces-{level}")
        finished.append(packed.where(F.col("sequence_id").isNotNull()))
        tasks, level, make = -(-tasks // MERGED_AT_ONCE), level + 1, _stored
        rows = packed.where(F.col("sequence_id").isNull()).coalesce(tasks)
    result = finished[0]
    for more in finished[1:]:
        result = result.unionByName(more)
    return result.drop("ids")
