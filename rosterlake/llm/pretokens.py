"""What the two tokenizer files do to a text before any merge, for whole words at a time.

Both tokenizers never join anything across the border between a visible character and the
white space after it. A text can therefore be cut at those borders, each part be encoded on
its own, and the codes of a part be remembered in the worker. That holds for texts of plain
characters (below); all other texts, and texts that hold a special token's string, are left
to the library's own steps.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import regex
from tokenizers import Tokenizer

# Characters that Python and the tokenizers library class alike (letter, digit, white space),
# lower-case alike and leave alone when composing: up to U+024F without four control characters
# that only Python counts as white space, and common punctuation.
_NOT_PLAIN = re.compile("[^\x00-\x1b\x20-ɏ‐-‧‰-⁞]")
# How a byte-level tokenizer splits a text.
BYTE_LEVEL_SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# A text is handled in slices of about so many characters, cut at white space.
SLICE_CHARS = 1 << 20
_WITH_SPACE_BEFORE = re.compile(r"\s*\S+|\s+")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself if it is a visible Latin-1
    character, else the next free one from U+0100 on, in the order of bytes."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {byte: chr(byte) for byte in visible}
    rest = (byte for byte in range(256) if byte not in letters)
    return letters | {byte: chr(0x100 + k) for k, byte in enumerate(rest)}


BYTE_LETTERS = byte_letters()


def load(path: str) -> Tokenizer:
    """The tokenizer of a file, without any truncation or padding that the file asks for."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def special_strings(tokenizer: Tokenizer) -> re.Pattern[str] | None:
    """Finds the strings that the tokenizer takes out of a text first; None if there are none."""
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    longest_first = sorted(added, key=len, reverse=True)
    return re.compile("|".join(map(re.escape, longest_first))) if added else None


def is_plain(text: str) -> bool:
    return _NOT_PLAIN.search(text) is None


def slices(text: str) -> Iterator[str]:
    """The text in parts of about SLICE_CHARS, each but the first beginning with white space
    that follows a visible character. A part without such a border stays whole."""
    begin, border = 0, re.compile(r"(?<=\S)\s")
    while len(text) - begin > SLICE_CHARS:
        found = border.search(text, begin + SLICE_CHARS)
        if found is None:
            break
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:] if begin else text


def spaced_words(text: str) -> list[str]:
    """The words of a text, each with all white space before it."""
    return _WITH_SPACE_BEFORE.findall(text)


class Remembered(dict):
    """Answers by key, computed when first asked for.

    Keys longer than ``longest`` are not kept. At most twice ``limit`` answers are: when the newer half is full it becomes the older
    half, and an answer found there moves to the newer one. So what is asked for often stays.
    """

    def __init__(self, compute, limit: int, longest: int):
        super().__init__()
        self.compute, self.limit, self.longest, self.older = compute, limit, longest, {}

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.compute(key)
        answer = self.older.get(key)
        if answer is None:
            answer = self.compute(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = answer
        return answer
