"""Conversations as training texts: rendered by a compiled template, with a mask of what to learn.

Conversations are dealt out by id and sorted by turn on disk, then streamed: a task holds one
batch of rows and one message ahead, never a conversation. A conversation comes out as pieces,
numbered from 0, each with its place in the conversation's output and the spans (begin and end in
code points of the whole output) that lie in generation blocks. A span never runs over two pieces.

Control strings inside texts are escaped: every ``<`` followed by any number of backslashes and a
``|`` gets one more backslash, so no text holds ``<|``, and taking one backslash away restores it.
In roles, backslashes and line breaks are escaped as well, since a role ends with its line.

A null text is empty, as is a null role. Rows of a conversation that share a turn stand in the order
of role and text, a null turn first; repeated rows are turns of their own. Rows without a
conversation id make one conversation, whose id is null. An empty table has no pieces.

A digest of a conversation takes its text byte after byte, so the rows of one conversation, however
many, are rendered by one task; its memory does not grow with them, only its time does.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.chat_template import FILTERS, Fragment, Template, shown

# A piece is closed at the first place outside a mask after this many code points.
PIECE_CHARS = 1 << 16
_ROWS = 1024

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED_CONTROL = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _ESCAPED_CONTROL.sub(r"<\1|", text) if "|" in text else text


def escape_line(text: str) -> str:
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_line(text: str) -> str:
    plain = unescape(text)
    return re.sub(r"\\(.)", lambda found: "\n" if found[1] == "n" else found[1], plain)


_FILTERS = FILTERS | {
    "escape": lambda text: escape(shown(text)),
    "escape_line": lambda text: escape_line(shown(text)),
}


@dataclass(frozen=True)
class ChatFormat:
    """A template and the control strings by which its output is read back.

    Between ``start`` and the end of the line stands the role, from there to ``end`` the text.
    """

    template: str
    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"

    def compiled(self) -> Template:
        return Template(self.template, ("start", "end"), _FILTERS)


CHATML = ChatFormat(
    """
{%- for message in messages -%}
  {{- start ~ message.role|escape_line ~ '\\n' -}}
  {%- if message.role == 'assistant' -%}
    {%- generation -%} {{- message.text|escape -}} {%- endgeneration -%}
  {%- else -%}
    {{- message.text|escape -}}
  {%- endif -%}
  {{- end -}}
{%- endfor -%}
"""
)


# --- formatting --------------------------------------------------------------

PIECE = (
    "conv_id long, piece long, begin long, text string, "
    "spans array<struct<begin: long, end: long>>"
)
_PIECE = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("piece", pa.int64()),
        ("begin", pa.int64()),
        ("text", pa.string()),
        ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
    ]
)


def _pieces(fragments: Iterable[Fragment]) -> Iterator[dict]:
    """Pieces of one conversation's output."""
    texts: list[str] = []
    spans: list[dict] = []
    piece = begin = at = 0
    was_masked = False
    for text, masked in fragments:
        if not masked and at - begin > PIECE_CHARS:
            yield {"piece": piece, "begin": begin, "text": "".join(texts), "spans": spans}
            texts, spans, piece, begin = [], [], piece + 1, at
        end = at + len(text)
        if masked and was_masked:
            spans[-1]["end"] = end
        elif masked:
            spans.append({"begin": at, "end": end})
        texts.append(text)
        at, was_masked = end, masked
    if texts:
        yield {"piece": piece, "begin": begin, "text": "".join(texts), "spans": spans}


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded length; rows with texts also count their code points."""
    found: list[dict] = []
    chars = 0
    for row in rows:
        found.append(row)
        chars += len(row.get("text", ""))
        if len(found) == _ROWS or chars > 64 * PIECE_CHARS:
            yield pa.RecordBatch.from_pylist(found, schema)
            found, chars = [], 0
    if found:
        yield pa.RecordBatch.from_pylist(found, schema)


def format_conversations(turns: DataFrame, chat: ChatFormat = CHATML) -> DataFrame:
    """Pieces of all conversations, in order inside each partition.

    ``turns`` has columns conv_id, turn, role and text; others are not read. The pieces of a
    conversation lie in one partition.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = chat.compiled()

        def pieces() -> Iterator[dict]:
            for conv_id, rows in groupby(_rows(batches), key=itemgetter(0)):
                messages = ({"role": role or "", "text": text or ""} for _, role, text in rows)
                for piece in _pieces(template.render(messages, start=chat.start, end=chat.end)):
                    yield {"conv_id": conv_id} | piece

        yield from _batches(pieces(), _PIECE)

    dealt = turns.select(F.col("conv_id").cast("long"), "turn", "role", "text").repartition("conv_id")
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, PIECE)


# --- reading back ------------------------------------------------------------

READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)
_READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


class _Reader:
    """Reads the turns and the text under the mask out of the pieces of one conversation."""

    def __init__(self, chat: ChatFormat):
        self.chat = chat
        self.rest = ""
        self.n_turns = self.loss_chars = self.chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def take(self, text: str, begin: int, spans: Iterable[dict]) -> None:
        if begin != self.chars:
            raise ValueError(f"a piece begins at {begin}, but {self.chars} code points came before")
        self.chars += len(text)
        for span in spans:
            learned = unescape(text[span["begin"] - begin : span["end"] - begin])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())
        # what is left of the last piece is part of a single turn
        *whole, self.rest = (self.rest + text).split(self.chat.end)
        for turn in whole:
            role, line, content = turn.partition("\n")
            if not role.startswith(self.chat.start) or not line:
                raise ValueError("a turn doesn't begin with its start mark and role")
            role = unescape_line(role[len(self.chat.start) :])
            self.n_turns += 1
            self.turns.update(f"{role}\n{unescape(content)}\n".encode())

    def result(self) -> dict:
        if self.rest:
            raise ValueError("the last turn has no end mark")
        return {
            "n_turns": self.n_turns,
            "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


def read_back(pieces: DataFrame, chat: ChatFormat = CHATML, in_order: bool = False) -> DataFrame:
    """Per conversation, from its pieces alone: turns with a digest of role, line break, text and
    line break per turn; code points and digest of the text under the mask, unescaped; length.

    ``in_order``: the pieces come straight from ``format_conversations``, in its partitions.
    Otherwise, as for a stored table, they are dealt out and sorted anew.
    """
    if not in_order:
        dealt = pieces.repartition("conv_id")
        pieces = dealt.sortWithinPartitions("conv_id", "piece")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[dict]:
            for conv_id, rows in groupby(_rows(batches), key=itemgetter(0)):
                reader = _Reader(chat)
                for _, begin, text, spans in rows:
                    reader.take(text, begin, spans)
                yield {"conv_id": conv_id} | reader.result()

        yield from _batches(results(), _READ)

    return pieces.select("conv_id", "begin", "text", "spans").mapInArrow(run, READ)
