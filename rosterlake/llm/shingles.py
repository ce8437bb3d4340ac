"""Distinct word shingles of whole texts as sorted 64-bit hashes, many texts at a time.

Words are runs of bytes other than space and 0x09 to 0x0D, with A-Z in lower case. Hashes are
polynomials over bytes, modulo 2^64, so that all words of a stretch of text are hashed by a
running sum. They do not depend on the process or the run. Two different shingles share a hash
with a chance of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes that are hashed at a time; about 40 bytes of memory for each.
STRETCH = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers in which every input bit reaches every output."""
    v = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each byte, whether it belongs to a word, and its value in the hash."""
    in_word = np.ones(256, bool)
    in_word[[0x20, *range(0x09, 0x0E)]] = False
    lower = np.arange(256, dtype=np.uint64)
    lower[ord("A") : ord("Z") + 1] += np.uint64(32)
    return in_word, mix((lower + np.uint64(1)) * _ODD)


_IN_WORD, _VALUE = _tables()


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


_BASE = 0x5851F42D4C957F2D  # odd, so that it has an inverse modulo 2^64
_UP = _powers(_BASE, STRETCH + 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), STRETCH + 1)


def _stretches(data: np.ndarray, breaks: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of stretches that cut no word; only a longer word makes a longer one."""
    begin = 0
    while begin < len(data):
        end = begin + STRETCH
        if end >= len(data):
            yield begin, len(data)
            return
        at = end
        while at > begin and _IN_WORD[data[at]] and _IN_WORD[data[at - 1]]:
            k = np.searchsorted(breaks, at)
            if k < len(breaks) and breaks[k] == at:
                break
            at -= 1
        if at == begin:  # one word fills the stretch: look for its end
            rest = np.flatnonzero(~_IN_WORD[data[end:]])
            after = breaks[np.searchsorted(breaks, end) :]
            at = min(
                end + int(rest[0]) if len(rest) else len(data),
                int(after[0]) if len(after) else len(data),
            )
        yield begin, at
        begin = at


def _word_hashes(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the place where each begins; no word goes across a break."""
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for begin, end in _stretches(data, breaks):
        some = data[begin:end]
        word = _IN_WORD[some]
        edge = np.empty(len(some) + 1, bool)
        edge[0], edge[-1] = word[0], word[-1]
        np.not_equal(word[1:], word[:-1], out=edge[1:-1])
        inner = breaks[np.searchsorted(breaks, begin, "right") : np.searchsorted(breaks, end)] - begin
        split = inner[word[inner] & word[inner - 1]] if len(inner) else inner
        bounds = np.flatnonzero(edge)
        if len(split):  # a text ends and the next begins within a run
            bounds = np.sort(np.concatenate([bounds, split, split]))
        first, last = bounds[0::2], bounds[1::2]
        if len(some) < len(_UP):
            up, down = _UP[: len(some)], _DOWN
        else:
            up, down = _powers(_BASE, len(some)), _powers(pow(_BASE, -1, 1 << 64), len(some))
        sums = np.zeros(len(some) + 1, np.uint64)
        np.cumsum(_VALUE[some] * up, out=sums[1:])
        hashes.append(mix((sums[last] - sums[first]) * down[first]))
        places.append(first + begin)
    return np.concatenate(hashes), np.concatenate(places)


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all texts, one after the other, and the bounds between texts.

    For each text its distinct shingles of ``k`` words, sorted; with fewer words, the whole
    sequence as one; without words or text, none.
    """
    count = len(texts)
    texts = texts.cast(pa.large_string()).cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + count + 1]
    if texts.null_count:
        texts = texts.fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + count + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    hashes, places = _word_hashes(data, np.unique(offsets[1:-1]))
    words = np.searchsorted(places, offsets)  # the first word of each text
    sets, bounds = [], np.zeros(count + 1, np.int64)
    factors = [int(f) | 1 for f in mix(np.arange(1, k + 1, dtype=np.uint64) * _ODD)]
    windows = np.zeros(max(0, len(hashes) - k + 1), np.uint64)
    for j, factor in enumerate(factors):
        windows += hashes[j : j + len(windows)] * np.uint64(factor)
    windows = mix(windows)
    for t in range(count):
        first, last = words[t], words[t + 1]
        if last - first >= k:
            own = np.unique(windows[first : last - k + 1])
        elif last > first:
            total = sum(int(h) * f for h, f in zip(hashes[first:last], factors, strict=False))
            short = (total + 0xD6E8FEB86659FD93 * int(last - first)) & (2**64 - 1)
            own = mix(np.array([short], np.uint64))
        else:
            own = np.zeros(0, np.uint64)
        sets.append(own)
        bounds[t + 1] = bounds[t] + len(own)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), bounds


def set_hashes(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit number for each set, the same for equal sets; 0 only for the empty set."""
    sums = np.zeros(len(shingles) + 1, np.uint64)
    np.cumsum(mix(shingles ^ _ODD), out=sums[1:])
    sizes = np.diff(bounds).astype(np.uint64)
    result = mix((sums[bounds[1:]] - sums[bounds[:-1]]) + sizes * _ODD)
    result[result == 0] = 1
    result[sizes == 0] = 0
    return result
