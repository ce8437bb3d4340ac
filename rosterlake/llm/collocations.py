"""Phrase collocations by SON partitioning: shards are mined, then their finds are counted.

The words of a language that a task reads are cut into shards of bounded size. Each shard is mined
completely: of a phrase wanted ``support`` times in all, a shard with the share s of the language's
bytes reports every phrase it holds ``ceil(support * s)`` times or more. A phrase that no shard
reports is missed less than ``support`` times in all, so the union of the reports holds every
frequent phrase. A report says by how much it exceeds what the shard might have kept to itself;
sums of that bound the count of a phrase from above, and phrases below the support go. The
phrases left, in a bit table of fixed size, are counted exactly over all documents, as texts.

Phrases of one and two words are mined first; longer ones, a word more at a time, only where both
phrases that they consist of were left. Shards deal in hashes, computed for millions of
bytes at once; a clash of hashes or of bits sends a phrase too many to the count and
never loses one. The count itself groups texts (inside a shard, by two hashes).

Words are runs of bytes other than spaces and tabs, A to Z in lower case; phrases lie inside pieces
between the marks ``. , ; : ! ?`` and line breaks. A null text has no words; a null language is
``und``. Repeated rows count each time. Long texts are read in slices that share their last words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.llm.scratch import store

MAX_WORDS, SUPPORT, TOP, COVERED_PERCENT = 3, 10, 2000, 50
# Bits of a phrase's hash; fewer make reports smaller, and more phrases too many are counted.
KEY_BITS = 48
# Bits of the table of phrases to be counted: 32 MB on the driver and in each worker.
FILTER_BITS = 28
# Languages whose size is known to all shards, largest first; a shard reports all phrases of others.
SIZED_LANGUAGES = 1000
_ROWS = 1 << 16
# Texts that are dealt out to their languages at a time.
_TEXTS = 2000

_BLANK, _MARK = 1, 2
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[0x20, 0x09]] = _BLANK
_CLASS[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = _MARK



@dataclass(frozen=True)
class Bounds:
    """What a worker holds at a time; results don't depend on it."""

    # bytes tokenized at a time, words of a shard to be mined, and of one to be counted: some 300 MB
    slice_bytes: int = 1 << 21
    shard_words: int = 1 << 22
    counted_words: int = 1 << 20
    # languages with as many bytes are mined at support 1 in every shard
    large_bytes: int = 1 << 26


_U = np.uint64
_BLANK_BYTE = b" "


# --- words -------------------------------------------------------------------


def _mixed(values: np.ndarray, factor: int) -> np.ndarray:
    values ^= values >> _U(32)
    values *= _U(factor)
    values ^= values >> _U(29)
    return values


class _Hash:
    """A 64-bit hash of words and phrases."""

    def __init__(self, seed: int):
        numbers = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, 64).tolist()
        self.seed, self.factor, *self.odd = [2 * number + 1 for number in numbers]

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the words at the given places, eight bytes at a time."""
        padded = np.append(data, np.zeros(8, dtype=np.uint8))
        # the eight bytes from each place on, as one number
        eights = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
        lengths = ends - starts
        found = lengths.astype(np.uint64) * _U(self.seed)
        rest, at = np.arange(len(starts)), starts
        while len(rest):
            left = ends[rest] - at
            bits = (8 * np.minimum(left, 8)).astype(np.uint64)
            part = eights[at] & (~_U(0) >> (_U(64) - bits))
            found[rest] = _mixed((found[rest] ^ part) * _U(self.factor), self.seed)
            longer = left > 8
            rest, at = rest[longer], at[longer] + 8
        return found

    def phrases(self, words: np.ndarray, size: int, language: int) -> np.ndarray:
        """Hashes, of fewer bits, of the phrases of ``size`` words that begin at each word."""
        count = max(len(words) - size + 1, 0)
        found = np.full(count, (language * self.seed + size) % (1 << 64), dtype=np.uint64)
        for i in range(size):
            found += words[i : i + count] * _U(self.odd[i % len(self.odd)] * (2 * i + 1) % (1 << 64))
        return _mixed(found, self.factor) >> _U(64 - KEY_BITS)


def language_hash(language: str) -> int:
    return int.from_bytes(hashlib.sha256(language.encode()).digest()[:8], "little")


@dataclass
class _Slice:
    """Words of some documents, or of a stretch of one, in lower case."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    # the number of the piece that each word lies in, and of the piece in which the slice ends
    piece: np.ndarray
    last_piece: int
    # the first word, and bytes, that no earlier slice held
    fresh: int
    size: int


def _tokenized(data: np.ndarray, fresh_from: int = 0) -> _Slice:
    data = np.frombuffer(data.tobytes().lower(), dtype=np.uint8)
    kind = _CLASS[data]
    word = np.zeros(len(data) + 2, dtype=bool)
    np.equal(kind, 0, out=word[1:-1])
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[0::2], edges[1::2]
    pieces = np.cumsum(kind == _MARK, dtype=np.int32)
    last_piece = int(pieces[-1]) if len(pieces) else 0
    fresh = int(np.searchsorted(starts, fresh_from))
    return _Slice(data, starts, ends, pieces[starts], last_piece, fresh, len(data) - fresh_from)


def _long_text(data: np.ndarray, context: int, slice_bytes: int) -> Iterator[_Slice]:
    """Slices of a long text, each led by the words of its piece that phrases may begin with."""
    lead = at = 0
    led_by = np.empty(0, dtype=np.uint8)
    while at < len(data):
        end = min(at + slice_bytes, len(data))
        while end < len(data) and not _CLASS[data[end - 1]]:  # don't cut a word
            window = np.flatnonzero(_CLASS[data[end : end + slice_bytes]])
            end = end + int(window[0]) + 1 if len(window) else min(end + slice_bytes, len(data))
        found = _tokenized(np.concatenate([led_by, data[at:end]]), lead)
        yield found
        tail = range(max(len(found.starts) - context, 0), len(found.starts))
        words = [
            found.data[found.starts[i] : found.ends[i]].tobytes() + _BLANK_BYTE
            for i in tail
            if found.piece[i] == found.last_piece
        ]
        led_by = np.frombuffer(b"".join(words), dtype=np.uint8)
        lead, at = len(led_by), end


def _slices(texts: pa.Array, context: int, slice_bytes: int) -> Iterator[_Slice]:
    """The words of an array of texts, each of which ends in a mark."""
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(offsets, dtype=width)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(offsets, int(offsets[at]) + slice_bytes, side="right")) - 1
        if end > at:
            yield _tokenized(data[offsets[at] : offsets[end]])
        else:
            end = at + 1
            yield from _long_text(data[offsets[at] : offsets[end]], context, slice_bytes)
        at = end


# --- shards ------------------------------------------------------------------


@dataclass(frozen=True)
class _Known:
    """What every shard knows: the phrases wanted, and languages with their bytes."""

    support: int
    max_words: int
    languages: tuple[str, ...]
    bytes: tuple[int, ...]
    bounds: Bounds

    def number(self, language: str) -> int:
        return self.languages.index(language) if language in self.languages else -1

    def small(self) -> list[int]:
        """Languages of which a shard may keep something."""
        return [number for number, size in enumerate(self.bytes) if 0 < size < self.bounds.large_bytes]

    def kept(self, number: int, size: int) -> int:
        """How often a phrase may occur in ``size`` bytes of a language without being reported."""
        if number not in self.small():
            return 0
        return max(0, -(-self.support * size // self.bytes[number]) - 1)


class _Words:
    """Words of one language, with their hashes."""

    def __init__(self, hashes: list[_Hash], keep_text: bool):
        self.hashes, self.keep_text = hashes, keep_text
        self.bytes = self.pieces = self.at = 0
        self.parts: list[list[np.ndarray]] = []
        self.data: list[np.ndarray] = []

    def add(self, found: _Slice) -> None:
        part = [hash_.words(found.data, found.starts, found.ends) for hash_ in self.hashes]
        part.append(found.piece + np.int32(self.pieces))
        part.append(np.arange(len(found.starts)) >= found.fresh)
        if self.keep_text:
            end = self.at + len(found.data)
            width = np.int32 if end < 1 << 31 else np.int64
            part += [(edge + self.at).astype(width) for edge in (found.starts, found.ends)]
            self.data.append(found.data)
            self.at = end
        self.parts.append(part)
        self.bytes += found.size
        self.pieces += found.last_piece + 1

    def joined(self) -> list[np.ndarray]:
        """The words' columns, which are then kept no more."""
        columns = [np.concatenate(column) for column in zip(*self.parts)]
        self.parts = []
        return columns


Shard = dict[str, _Words]


def _here(piece: np.ndarray, fresh: np.ndarray, size: int) -> np.ndarray:
    """Whether a phrase of ``size`` words begins at each word and ends in a new word."""
    return (piece[: len(piece) - size + 1] == piece[size - 1 :]) & fresh[size - 1 :]


def _edges(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _mined(
    shard: Shard, known: _Known, sizes: list[int], left
) -> Iterator[tuple[int, np.ndarray | None, np.ndarray]]:
    """(language, hashes of phrases, excess of their counts over what the shard may keep) and, with
    no hash, minus what it may keep. Languages of unknown size are number -1.

    ``left`` says by their hashes which phrases of a word less may be frequent.
    """
    for name, found in shard.items():
        number, language = known.number(name), language_hash(name)
        kept = known.kept(number, found.bytes)
        if kept:
            yield number, None, np.array([-kept])
        words, piece, fresh = found.joined()
        for size in sizes:
            if len(words) < size:
                continue
            wanted = _here(piece, fresh, size)
            hash_ = found.hashes[0]
            if left is not None:
                shorter = left(hash_.phrases(words, size - 1, language))
                wanted &= shorter[:-1] & shorter[1:]
            keys = hash_.phrases(words, size, language)[wanted]
            keys.sort()
            edges = _edges(keys)
            counts = np.diff(edges, append=len(keys))
            often = counts > kept
            yield number, keys[edges[often]], counts[often] - kept


def _counted(
    shard: Shard, sizes: list[int], left
) -> Iterator[tuple[str, int, list[str], np.ndarray]]:
    """(language, size, phrases, their counts) of the phrases that ``left`` lets pass, and the
    count of all words as size 0. A phrase may come more than once."""
    for name, found in shard.items():
        language = language_hash(name)
        data = b"".join(part.tobytes() for part in found.data)
        found.data = []
        words, others, piece, fresh, starts, ends = found.joined()
        yield name, 0, [""], np.array([np.count_nonzero(fresh)])
        for size in sizes:
            if len(words) < size:
                continue
            keys = found.hashes[0].phrases(words, size, language)
            at = np.flatnonzero(_here(piece, fresh, size) & left(keys))
            keys, second = keys[at], found.hashes[1].phrases(others, size, language)[at]
            order = np.argsort(keys)
            edges = _edges(keys[order], second[order])
            counts = np.diff(edges, append=len(at))
            at = at[order[edges]]
            for block in range(0, len(at), _ROWS):
                first = at[block : block + _ROWS]
                bounds = [zip(starts[first + i].tolist(), ends[first + i].tolist()) for i in range(size)]
                parts = zip(*([data[begin:end] for begin, end in bound] for bound in bounds))
                phrases = [b" ".join(row).decode("utf-8", "replace") for row in parts]
                yield name, size, phrases, counts[block : block + _ROWS]


def _shards(batches: Iterable[pa.RecordBatch], known: _Known, n_hashes: int) -> Iterator[Shard]:
    """Shards of the documents of a task, from columns of texts and languages."""
    hashes = [_Hash(seed) for seed in range(n_hashes)]
    bounds = known.bounds
    most = bounds.shard_words if n_hashes == 1 else bounds.counted_words
    shard: Shard = {}
    n_words = 0
    parts = (
        batch.slice(at, _TEXTS) for batch in batches for at in range(0, batch.num_rows, _TEXTS)
    )
    for part in parts:
        # a mark after each text parts it from the next one
        texts = pc.binary_join_element_wise(part.column(0).fill_null(""), "\n", "")
        languages = part.column(1)
        for name in languages.unique().to_pylist():
            of_language = texts.filter(pc.equal(languages, name))
            for found in _slices(of_language, known.max_words - 1, bounds.slice_bytes):
                shard.setdefault(name, _Words(hashes, n_hashes > 1)).add(found)
                n_words += len(found.starts)
                if n_words >= most:
                    yield shard
                    shard, n_words = {}, 0
    if shard:
        yield shard


# --- the table of phrases left -----------------------------------------------


def _probes(key):
    """Two places in the table for a hash, as Spark columns or as numpy arrays."""
    if isinstance(key, np.ndarray):
        mask = _U((1 << FILTER_BITS) - 1)
        return key & mask, key >> _U(KEY_BITS - FILTER_BITS)
    mask = F.lit((1 << FILTER_BITS) - 1)
    return key.bitwiseAND(mask), F.shiftright(key, KEY_BITS - FILTER_BITS)


def _bits(keys: DataFrame) -> np.ndarray:
    """The table of the hashes in column ``key``: of fixed size, made of parts of 4 KB."""
    place = keys.select(F.explode(F.array(*_probes(F.col("key")))).alias("place"))
    parts = place.groupBy(F.shiftright("place", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits")
    )
    table = np.zeros((1 << FILTER_BITS) >> 3, dtype=np.uint8)
    for part, bits in parts.toLocalIterator():
        table[part << 12 : (part << 12) + len(bits)] = np.frombuffer(bits, dtype=np.uint8)
    return table


def _member(table: np.ndarray):
    def left(keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), dtype=bool)
        for at in range(0, len(keys), _ROWS):
            block = slice(at, at + _ROWS)
            for place in _probes(keys[block]):
                bit = table[place >> _U(3)] >> (place & _U(7)).astype(np.uint8)
                found[block] &= (bit & 1).astype(bool)
        return found

    return left


# --- passes over the documents -----------------------------------------------

_MINED = pa.schema([("language", pa.int32()), ("key", pa.int64()), ("excess", pa.int64())])
_COUNTED = pa.schema(
    [("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())]
)


def _left_after_mining(docs: DataFrame, known: _Known, sizes: list[int], table) -> np.ndarray:
    """The table of the hashes of phrases that may be frequent, by the reports of all shards."""
    shared = None if table is None else docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None if shared is None else _member(shared.value)
        for shard in _shards(batches, known, 1):
            for language, keys, excess in _mined(shard, known, sizes, left):
                for at in range(0, len(excess), _ROWS):
                    part = excess[at : at + _ROWS]
                    key = [None] if keys is None else keys[at : at + _ROWS].view(np.int64)
                    number = np.full(len(part), language, dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(number), pa.array(key, pa.int64()), pa.array(part)], schema=_MINED
                    )

    reports = docs.mapInArrow(run, "language int, key long, excess long")
    # shards hardly share phrases with themselves: no sums before the shuffle
    summed = reports.repartition("language", "key").groupBy("language", "key").agg(
        F.sum("excess").alias("excess")
    )
    # of large languages nothing is kept, and sums are final
    may_pass = (F.col("excess") >= known.support) | F.col("language").isin(known.small())
    stored = store(summed.where(may_pass), "reports")
    # below 0: what all shards of a language may have kept; one row per known language
    kept = stored.where("excess < 0").select("language", (-F.col("excess")).alias("kept"))
    bounded = stored.where("excess > 0").join(F.broadcast(kept), "language", "left")
    found = _bits(bounded.where(F.col("excess") + F.coalesce("kept", F.lit(0)) >= known.support))
    if shared is not None:
        shared.destroy()
    return found


def frequent_phrases(
    docs: DataFrame,
    max_words: int = MAX_WORDS,
    support: int = SUPPORT,
    bounds: Bounds = Bounds(),
) -> DataFrame:
    """``lang``, ``size``, ``phrase`` (words joined by single spaces) and ``f``, its exact count, of
    all phrases of up to ``max_words`` words that occur ``support`` times or more in their
    language. Size 0, with an empty phrase, is the language's count of all words.

    ``docs`` has columns lang and text; others are not read. The result is stored, and the passes
    before run when this is called.
    """
    language = F.coalesce("lang", F.lit("und"))
    docs = docs.select("text", language.alias("lang"))
    # the largest languages only: a bounded number of rows for the driver
    with_mark = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    sized = docs.groupBy("lang").agg(F.sum(with_mark).alias("n"))
    sized = sized.orderBy(F.desc("n"), "lang").limit(SIZED_LANGUAGES).collect()
    names, sizes = (tuple(row[name] for row in sized) for name in ("lang", "n"))
    known = _Known(support, max_words, names, sizes, bounds)
    table = _left_after_mining(docs, known, [size for size in (1, 2) if size <= max_words], None)
    for size in range(3, max_words + 1):
        table |= _left_after_mining(docs, known, [size], table)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = _member(shared.value)
        for shard in _shards(batches, known, 2):
            for name, size, phrases, counts in _counted(shard, list(range(1, max_words + 1)), left):
                columns = [
                    pa.array([name] * len(counts)),
                    pa.array([size] * len(counts), pa.int32()),
                    pa.array(phrases),
                    pa.array(counts),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_COUNTED)

    counted = docs.mapInArrow(run, "lang string, size int, phrase string, f long")
    totals = counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return store(totals.where((F.col("size") == 0) | (F.col("f") >= support)), "phrases")


# --- scores ------------------------------------------------------------------


def _words(begin, length):
    return F.array_join(F.slice("words", begin, length), " ")


def _cuts(phrases: DataFrame) -> DataFrame:
    """Each phrase of two words or more with each of its cuts: k, first and rest."""
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    split = phrases.where("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = split.select("lang", "phrase", F.col("f").alias("a"), "size", "words", cut)
    rest = _words(F.col("k") + 1, F.col("size") - F.col("k"))
    return cuts.select(
        "lang", "phrase", "a", "k", _words(F.lit(1), F.col("k")).alias("first"), rest.alias("rest")
    )


def scored(phrases: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r`` and ``score`` at the cut that scores lowest, of
    ``phrases`` with lang, size, phrase and f, their parts included. Arithmetic is exact up to
    counts of 16 digits."""

    def part(name: str, count: str) -> DataFrame:
        return phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))

    cuts = _cuts(phrases).join(part("first", "l"), ["lang", "first"])
    cuts = cuts.join(part("rest", "r"), ["lang", "rest"])
    # whole numbers of up to 38 digits; a part is at least as frequent, so a score fits a long
    exact = {name: f"cast({name} as decimal(16, 0))" for name in "alr"}
    score = F.expr("1000000 * ({a} * {a}) div ({l} * {r})".format(**exact))
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a")).alias("best")
    )
    return best.select("lang", "phrase", "best.a", "best.l", "best.r", "best.score")


def _covering(phrases: DataFrame) -> DataFrame:
    """``longer``: the count of the most frequent longer phrase that holds each phrase."""
    split = phrases.where("size > 2").withColumn("words", F.split("phrase", " "))
    sizes = F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("inner")
    begins = F.explode(F.sequence(F.lit(1), F.col("size") - F.col("inner") + 1)).alias("begin")
    held = split.select("lang", "f", "size", "words", sizes).select("*", begins)
    held = held.select("lang", "f", _words(F.col("begin"), F.col("inner")).alias("phrase"))
    return held.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame,
    max_words: int = MAX_WORDS,
    support: int = SUPPORT,
    top: int = TOP,
    covered_percent: int = COVERED_PERCENT,
    bounds: Bounds = Bounds(),
) -> DataFrame:
    """The best phrases of two to ``max_words`` words of each language: ``lang``, ``rank``,
    ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    A phrase that occurs a times is cut after its first k words into parts that occur l and r
    times; its score is floor(1000000 * a * a / (l * r)), the lowest over its cuts, of equal ones
    the smallest k. Phrases inside a longer frequent one that occurs at least ``covered_percent``
    of their times are left out. Of the rest, the first ``top`` by score, a (both falling) and phrase
    (in byte order) are returned; n counts all words of the language.
    """
    found = frequent_phrases(docs, max_words, support, bounds)
    phrases, totals = found.where("size > 0"), found.where("size = 0")

    best = scored(phrases)
    covered = F.lit(100) * F.coalesce("longer", F.lit(0)) >= F.lit(covered_percent) * F.col("a")
    free = best.join(_covering(phrases), ["lang", "phrase"], "left").where(~covered)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = free.withColumn("rank", F.row_number().over(order).cast("long"))
    named = ranked.where(F.col("rank") <= top).join(
        totals.select("lang", F.col("f").alias("n")), "lang"
    )
    return named.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
