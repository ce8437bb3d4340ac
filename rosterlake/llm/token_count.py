"""Token counts by a two-tier lookup on the map side.

First tier: a table of the most frequent pre-tokens and their token counts, of bounded size,
sent to every worker. Second tier: what the table lacks is encoded by the library and kept in
a cache of the worker. No pre-token is ever shuffled: frequent ones are found by summaries of
bounded size, one per task, which are merged in two steps.

A pre-token here is a word with the white space before it; the tokenizer's own, finer split
never joins two of them, so their counts add up.
"""

from __future__ import annotations

import functools
import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from rosterlake.llm import pretokens

# Entries of a summary and so of the table that is broadcast; at most MAX_KEY characters each:
# 32,768 x (4 x 32 + 100) bytes are 8 MB.
SUMMARY_ENTRIES = 1 << 15
MAX_KEY = 32
# Pre-tokens a worker remembers at least, and at most twice as many (some 100 MB); longer ones
# than MAX_KEY are encoded each time.
CACHE_ENTRIES = 400_000
# Summaries that one task merges.
MERGED_AT_ONCE = 64

_SUMMARY = "part long, summary binary"


def _pack(counts: Counter) -> bytes:
    table = pa.table({"word": pa.array(list(counts), pa.string()), "n": list(counts.values())})
    table = table.cast(pa.schema([("word", pa.string()), ("n", pa.int64())]))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(summary: bytes) -> dict[str, int]:
    table = pa.ipc.open_stream(summary).read_all()
    return dict(zip(table["word"].to_pylist(), table["n"].to_pylist(), strict=True))


def _shrink(counts: Counter, entries: int) -> Counter:
    """Keep ``entries`` words: all counts lose what the first word left out has, as in a
    Misra-Gries summary. A word with more than 1 / entries of all words is never lost."""
    if len(counts) <= entries:
        return counts
    ranked = counts.most_common(entries + 1)
    loss = ranked[-1][1]
    return Counter({word: n - loss for word, n in ranked[:-1] if n > loss})


def _summarise(entries: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        number = 0
        for batch in batches:
            for text in batch.column(0):
                for part in pretokens.slices(text.as_py() or ""):
                    counts.update(pretokens.spaced_words(part))
                    if len(counts) > 16 * entries:
                        counts = _shrink(counts, 4 * entries)
            number = batch.num_rows + number
        short = Counter({word: n for word, n in counts.items() if len(word) <= MAX_KEY})
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "summary": [_pack(_shrink(short, entries))]},
            pa.schema([("part", pa.int64()), ("summary", pa.binary())]),
        )

    return run


def _merge(entries: int):
    def run(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in rows:
            for summary in batch.column("summary"):
                counts.update(_unpack(summary.as_py()))
                counts = _shrink(counts, 4 * entries)
        yield pa.RecordBatch.from_pydict(
            {"part": [key[0].as_py()], "summary": [_pack(_shrink(counts, entries))]},
            pa.schema([("part", pa.int64()), ("summary", pa.binary())]),
        )

    return run


def frequent_pretokens(texts: DataFrame, entries: int = SUMMARY_ENTRIES) -> list[str]:
    """The most frequent pre-tokens of a one-column table of texts, over all rows.

    At most ``entries`` words of MAX_KEY characters reach the driver.
    """
    parts = texts.mapInArrow(_summarise(entries), _SUMMARY)
    left = texts.rdd.getNumPartitions()
    while left > 1:
        left = -(-left // MERGED_AT_ONCE)
        group = F.pmod(F.col("part"), F.lit(left)).alias("part")
        parts = parts.select(group, "summary").groupBy("part").applyInArrow(
            _merge(entries), _SUMMARY
        )
    words: Counter = Counter()
    for row in parts.select("summary").collect():
        words.update(_unpack(bytes(row[0])))
    return list(_shrink(words, entries))


class _Counts:
    """Counts the tokens of texts; one per worker and tokenizer file."""

    def __init__(self, path: str):
        self.tokenizer = pretokens.load(path)
        self.specials = pretokens.special_strings(self.tokenizer)
        self.known = _Lengths(self._of_word)
        self.byte_level = self._is_byte_level()

    def _is_byte_level(self) -> bool:
        """Whether the file is of the plain byte-level kind, whose pre-tokens can be handed to
        its merges directly."""
        spec = json.loads(self.tokenizer.to_str())
        step = spec["pre_tokenizer"]
        return spec["normalizer"] is None and step == {
            "type": "ByteLevel",
            "add_prefix_space": False,
            "trim_offsets": True,
            "use_regex": True,
        }

    def _encode(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _of_word(self, word: str) -> int:
        if not self.byte_level:
            return self._encode(word)
        merge = self.tokenizer.model.tokenize
        letters = pretokens.BYTE_LETTERS
        return sum(
            [
                len(merge(piece.encode().decode("latin-1").translate(letters)))
                for piece in pretokens.BYTE_LEVEL_SPLIT.findall(word)
            ]
        )

    def of(self, text: str) -> int:
        if not pretokens.is_plain(text) or (self.specials and self.specials.search(text)):
            return self._encode(text)
        look_up = self.known.__getitem__
        return sum(
            sum(map(look_up, pretokens.spaced_words(part))) for part in pretokens.slices(text)
        )


class _Lengths(pretokens.Remembered):
    """Token counts by pre-token: the table of frequent ones first, then the worker's cache."""

    def __init__(self, compute):
        super().__init__(compute, CACHE_ENTRIES, MAX_KEY)
        self.frequent: dict[str, int] = {}

    def __missing__(self, key: str) -> int:
        known = self.frequent.get(key)
        if known is not None:
            return known
        return super().__missing__(key)


@functools.lru_cache(maxsize=4)
def _counts(path: str) -> _Counts:
    return _Counts(path)


def token_counter(texts: DataFrame, path: str, entries: int = SUMMARY_ENTRIES):
    """A function from a text column to its number of tokens by the tokenizer file ``path``.

    ``texts``: the one-column table whose frequent pre-tokens make the first tier; the result
    is right for any other text too. Counting takes whole texts, without begin, end or other
    added tokens; special strings in a text count as the library counts them. Null counts as
    the empty text, which has no tokens. The path must be readable on every executor.
    """
    spark = texts.sparkSession
    counts = _counts(path)
    table = {word: counts.known.compute(word) for word in frequent_pretokens(texts, entries)}
    sent = spark.sparkContext.broadcast(table)

    @arrow_udf(T.LongType())
    def count(column: pa.Array) -> pa.Array:
        worker = _counts(path)
        worker.known.frequent = sent.value
        return pa.array([worker.of(text.as_py() or "") for text in column], pa.int64())

    return count


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", limit: int = 1024
) -> dict[str, Column]:
    """Columns to add to ``docs``: ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``."""
    n_tokens = token_counter(docs.select(text), path)(F.col(text))
    return {
        "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"),
        "n_tokens": n_tokens,
        "over_limit": n_tokens > limit,
    }
