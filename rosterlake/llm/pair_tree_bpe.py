"""Byte-pair encoding with a segment tree over the ranks of adjacent pairs, and decoding.

For each word the tree's leaves hold the merge ranks of the pairs of neighbouring symbols.
The root is the leftmost pair of lowest rank; merging it changes three leaves, and each change
climbs to the root in logarithmic time. It ends when no pair can be merged.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql.functions import arrow_udf

from rosterlake.llm import pretokens

# Words and pieces of words a worker remembers at least (at most twice as many), and the
# longest of them: together some 300 MB at most.
WORD_ENTRIES = 250_000
PIECE_ENTRIES = 400_000
MAX_KEY = 32

RESULT = "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>"
_TYPE = pa.struct(
    [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


def merge_symbols(symbols: list[int], merges: dict[int, int], size: int) -> list[int]:
    """Merge neighbouring symbols until no pair is in ``merges``.

    ``merges``: left * size + right -> rank * size + merged symbol, with size above all symbols.
    A tree node holds rank * leaves + place of the best pair below it, so that the smaller of
    two nodes is the lower rank, or the place further left. O(n log n) for n symbols.
    """
    count = len(symbols)
    if count < 2:
        return symbols
    symbols = list(symbols)
    leaves = 1 << (count - 1).bit_length()
    none = size * size * leaves
    tree = [none] * (2 * leaves)
    look_up = merges.get
    found = False
    for place in range(count - 1):
        entry = look_up(symbols[place] * size + symbols[place + 1])
        if entry is not None:
            tree[leaves + place] = entry // size * leaves + place
            found = True
    if not found:
        return symbols
    for node in range(leaves - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    after = list(range(1, count + 1))
    before = list(range(-1, count - 1))
    while tree[1] < none:
        place = tree[1] % leaves
        gone = after[place]
        symbols[place] = merged = look_up(symbols[place] * size + symbols[gone]) % size
        symbols[gone] = -1
        right = after[place] = after[gone]
        left = before[place]
        tree[leaves + gone] = tree[leaves + place] = none
        if right < count:
            before[right] = place
            entry = look_up(merged * size + symbols[right])
            if entry is not None:
                tree[leaves + place] = entry // size * leaves + place
        if left >= 0:
            entry = look_up(symbols[left] * size + merged)
            tree[leaves + left] = none if entry is None else entry // size * leaves + left
        else:
            left = place
        # climb from the three leaves; where their ways meet, one step serves all
        first, second, third = (leaves + left) >> 1, (leaves + place) >> 1, (leaves + gone) >> 1
        while third:
            one, other = tree[2 * third], tree[2 * third + 1]
            tree[third] = one if one < other else other
            if second != third:
                one, other = tree[2 * second], tree[2 * second + 1]
                tree[second] = one if one < other else other
            if first != second:
                one, other = tree[2 * first], tree[2 * first + 1]
                tree[first] = one if one < other else other
            first >>= 1
            second >>= 1
            third >>= 1
    return [symbol for symbol in symbols if symbol >= 0]


class WordBpe:
    """Encodes and decodes by a tokenizer file of the word kind: white space is dropped, a
    suffix marks the end of a word, and no decoder is named, so that decoding joins the
    symbols' strings with blanks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] is not None or not model["end_of_word_suffix"]:
            raise ValueError(f"{path} is not a tokenizer file of the word kind")
        vocab: dict[str, int] = model["vocab"]
        self.library = pretokens.load(path)
        self.specials = pretokens.special_strings(self.library)
        self.special_ids = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split)
        self.letters = pretokens.BYTE_LETTERS
        self.letter_ids = {letter: vocab[letter] for letter in self.letters.values()}
        suffix = model["end_of_word_suffix"]
        self.last_ids = {letter: vocab[letter + suffix] for letter in self.letter_ids}
        self.size = max([*vocab.values(), *self.special_ids.values()]) + 1
        self.merges = {
            vocab[left] * self.size + vocab[right]: rank * self.size + vocab[left + right]
            for rank, (left, right) in enumerate(model["merges"])
        }
        self.strings = {i: string for string, i in vocab.items()} | {
            i: string for string, i in self.special_ids.items()
        }
        self.words = pretokens.Remembered(self._word, WORD_ENTRIES, MAX_KEY)
        self.known = pretokens.Remembered(self._piece, PIECE_ENTRIES, MAX_KEY)

    def _letters_to_ids(self, letters: str) -> list[int]:
        symbols = [self.letter_ids[letter] for letter in letters[:-1]]
        symbols.append(self.last_ids[letters[-1]])
        return merge_symbols(symbols, self.merges, self.size)

    def _packed(self, ids: list[int]) -> tuple[bytes, bytes]:
        """The ids as little-endian 32-bit integers and the decoded strings, joined."""
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        return packed, " ".join([self.strings[i] for i in ids]).encode()

    def _piece(self, piece: str) -> tuple[bytes, bytes]:
        letters = piece.encode().decode("latin-1").translate(self.letters)
        return self._packed(self._letters_to_ids(letters))

    def _word(self, word: str) -> tuple[bytes, bytes]:
        """The word's parts joined; most words are a single piece."""
        parts = [self.known[piece] for piece in self.pieces.findall(word)]
        if len(parts) == 1:
            return parts[0]
        return b"".join([part[0] for part in parts]), b" ".join([part[1] for part in parts])

    def _by_library_steps(self, text: str) -> tuple[bytes, bytes]:
        """As for a word, but the library normalises and splits."""
        ids: list[int] = []
        normal = self.library.normalizer.normalize_str(text)
        for letters, _ in self.library.pre_tokenizer.pre_tokenize_str(normal):
            ids += self._letters_to_ids(letters)
        return self._packed(ids)

    def _plain(self, text: str) -> Iterator[list[tuple[bytes, bytes]]]:
        if not pretokens.is_plain(text):
            yield [self._by_library_steps(text)]
            return
        for part in pretokens.slices(text):
            yield list(map(self.words.__getitem__, part.lower().split()))

    def encoded(self, text: str) -> Iterator[list[tuple[bytes, bytes]]]:
        """Packed ids and decoded strings of the text's words, in lists of bounded length."""
        end = 0
        if self.specials is not None:
            for found in self.specials.finditer(text):
                yield from self._plain(text[end : found.start()])
                yield [self._packed([self.special_ids[found.group()]])]
                end = found.end()
        yield from self._plain(text[end:] if end else text)

    def packed_ids(self, text: str) -> bytes:
        """The ids of the whole text as little-endian 32-bit integers."""
        return b"".join([part[0] for parts in self.encoded(text) for part in parts])

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.packed_ids(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.strings[i] for i in ids])


@functools.lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One per worker and file."""
    return WordBpe(path)


def _digests(bpe: WordBpe, text: str) -> dict:
    ids, decoded = hashlib.sha256(), hashlib.sha256()
    length, between = 0, b""
    for parts in bpe.encoded(text):
        packed = b"".join([part[0] for part in parts])
        if packed:
            ids.update(packed)
            length += len(packed)
            decoded.update(between + b" ".join([part[1] for part in parts if part[1]]))
            between = b" "
    return {
        "n_tokens": length // 4,
        "ids_sha256": ids.hexdigest(),
        "decoded_sha256": decoded.hexdigest(),
    }


def round_trip(path: str):
    """A function from a text column to a struct of ``n_tokens``, ``ids_sha256`` (of the ids as
    little-endian 32-bit integers) and ``decoded_sha256`` (of the decoded text in UTF-8).

    Null is the empty text: no tokens, digests of nothing. Texts are taken whole, whatever
    their length; the path must be readable on every executor.
    """

    @arrow_udf(RESULT)
    def run(column: pa.Array) -> pa.Array:
        bpe = word_bpe(path)
        return pa.array([_digests(bpe, text.as_py() or "") for text in column], _TYPE)

    return run


def encode_ids(path: str):
    """A function from a text column to the text's ids (array of int); null gives none."""

    @arrow_udf("array<int>")
    def run(column: pa.Array) -> pa.Array:
        bpe = word_bpe(path)
        return pa.array([bpe.ids(text.as_py() or "") for text in column], pa.list_(pa.int32()))

    return run


def decode_ids(path: str):
    """A function from a column of id arrays to the decoded texts; null stays null."""

    @arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        bpe = word_bpe(path)
        return pa.array(
            [None if ids.as_py() is None else bpe.decode(ids.as_py()) for ids in column],
            pa.string(),
        )

    return run
