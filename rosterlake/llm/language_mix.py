"""Languages of mixed texts: expectation-maximisation over words, with a penalty for each
language that a document is said to be in.

Training counts character trigrams of whole words by language, over all labelled documents.
A word's likelihood in a language is the product of its trigrams' smoothed probabilities. A
document is a mixture: each of its words is drawn from one of its languages. Starting from all
languages, EM estimates the proportions; then the language of the smallest share is dropped as
long as the penalised likelihood (half the logarithm of the number of words for each free
proportion) does not fall. Languages that no longer own a hundredth of a word go at once.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from rosterlake.llm import pretokens
from rosterlake.llm.scratch import store

# Trigrams are counted in 2^16 hash buckets: 512 KB for a language.
BUCKETS = 1 << 16
# Counts of a language go through the shuffle in so many pieces.
CHUNKS = 8
# What a model may weigh when it is broadcast: 500 languages.
MODEL_BYTES = 256 << 20
SMOOTHING = 0.5
# Words x languages of one EM run; texts are collected up to this many, a longer one runs alone.
RUN_CELLS = 1 << 19
EM_STEPS = 25
EM_TOLERANCE = 1e-4
UNKNOWN = "und"

RESULT = "struct<lang_pred: string, score: double, languages: array<string>, shares: array<double>>"
_COUNTS = pa.schema([("lang", pa.string()), ("chunk", pa.int32()), ("counts", pa.binary())])
_TYPE = pa.struct(
    [
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
        ("languages", pa.list_(pa.string())),
        ("shares", pa.list_(pa.float64())),
    ]
)


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter or a mark that belongs to one."""
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])


def word_trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the trigrams of all words, and where each word begins among them.

    A word is a longest run of letters, in lower case, with one border before and one after; a
    word of n letters has n trigrams.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes] if len(codes) else np.zeros(0, bool)
    if not letter.any():
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    padded = np.zeros(len(codes) + 2, np.uint32)
    padded[1:-1] = np.where(letter, codes, 0)
    at = np.flatnonzero(letter)
    mixed = padded[at] * np.uint32(0x9E3779B1)
    mixed = (mixed ^ (mixed >> np.uint32(15))) + padded[at + 1]
    mixed *= np.uint32(0x85EBCA77)
    mixed = (mixed ^ (mixed >> np.uint32(13))) + padded[at + 2]
    mixed *= np.uint32(0xC2B2AE3D)
    return mixed >> np.uint32(16), np.flatnonzero(padded[at] == 0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    waiting: dict[str, list[np.ndarray]] = {}

    def settle(lang: str) -> None:
        own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
        own += np.bincount(np.concatenate(waiting.pop(lang)), minlength=BUCKETS)

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            own = waiting.setdefault(lang.as_py(), [])
            for part in pretokens.slices(text.as_py()):
                own.append(word_trigrams(part)[0])
            if sum(map(len, own)) > 1 << 18:
                settle(lang.as_py())
    for lang in list(waiting):
        settle(lang)
    size = BUCKETS // CHUNKS
    for lang, own in counts.items():
        yield pa.RecordBatch.from_pydict(
            {
                "lang": [lang] * CHUNKS,
                "chunk": list(range(CHUNKS)),
                "counts": [own[k * size : (k + 1) * size].tobytes() for k in range(CHUNKS)],
            },
            _COUNTS,
        )


def _add(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS // CHUNKS, np.int64)
    for batch in rows:
        for counts in batch.column("counts"):
            total += np.frombuffer(counts.as_py(), np.int64)
    yield pa.RecordBatch.from_pydict(
        {"lang": [key[0].as_py()], "chunk": [key[1].as_py()], "counts": [total.tobytes()]}, _COUNTS
    )


class Model:
    """Languages in order of their names, and log probabilities by bucket and language."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = sorted(counts)
        smoothed = [counts[name] + SMOOTHING for name in self.languages]
        logs = [np.log(c / c.sum()) for c in smoothed]
        self.logs = np.array(logs, np.float32).T.copy() if logs else np.zeros((BUCKETS, 0))


def train(labelled: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """The model of all labelled texts; rows without a text or a language say nothing.

    Each task sends its counts by language, in pieces of fixed size; the sums reach the driver,
    512 KB for a language, MODEL_BYTES at most.
    """
    schema = "lang string, chunk int, counts binary"
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    totals = rows.mapInArrow(_count, schema).groupBy("lang", "chunk").applyInArrow(_add, schema)
    totals = store(totals, "trigrams")  # counted once, for the check below and for the model
    names = totals.select("lang").distinct().count()
    if names * BUCKETS * 8 > MODEL_BYTES:
        raise ValueError(f"{names} languages do not fit into a model of {MODEL_BYTES} bytes")
    counts: dict[str, np.ndarray] = {}
    size = BUCKETS // CHUNKS
    for row in totals.collect():
        own = counts.setdefault(row.lang, np.zeros(BUCKETS, np.int64))
        own[row.chunk * size : (row.chunk + 1) * size] = np.frombuffer(row.counts, np.int64)
    return Model(counts)


def word_likelihoods(model: Model, text: str) -> np.ndarray:
    """Words x languages: log likelihoods relative to the word's best language."""
    parts = [np.zeros((0, len(model.languages)), np.float32)]
    for part in pretokens.slices(text):
        buckets, starts = word_trigrams(part)
        if len(starts) and model.languages:
            logs = np.add.reduceat(model.logs[buckets], starts, axis=0)
            parts.append(logs - logs.max(axis=1, keepdims=True))
    return np.concatenate(parts) if len(parts) > 2 else parts[-1]


def _em(likelihood: np.ndarray, first: np.ndarray, n: np.ndarray, shares: np.ndarray):
    """Shares of the languages of each document, from given ones on, and log likelihoods.

    ``likelihood``: words x languages; ``first``, ``n``: where a document's words begin and how
    many there are. A language of share 0 keeps it.
    """
    of = np.repeat(np.arange(len(n)), n)
    for _ in range(EM_STEPS):
        joint = likelihood * shares[of]
        total = joint.sum(axis=1, keepdims=True)
        renewed = np.add.reduceat(joint / total, first, axis=0) / n[:, None]
        moved = np.abs(renewed - shares).max()
        shares = renewed
        if moved < EM_TOLERANCE:
            break
    total = np.einsum("ij,ij->i", likelihood, shares[of])
    return shares, np.add.reduceat(np.log(total), first)


def mixtures(logs: list[np.ndarray]) -> np.ndarray:
    """Documents x languages: estimated shares; documents have at least one word each.

    ``logs``: for each document its words' log likelihoods.
    """
    n = np.array([len(own) for own in logs])
    likelihood = np.exp(np.maximum(np.concatenate(logs), -80.0)).astype(np.float64)
    languages = likelihood.shape[1]
    bounds = np.concatenate([[0], np.cumsum(n)])
    result = np.full((len(n), languages), 1.0 / languages)
    result, fit = _em(likelihood, bounds[:-1], n, result)
    score = fit - 0.5 * np.log(n) * (languages - 1)
    open_docs = np.arange(len(n))
    while len(open_docs):
        shares = result[open_docs]
        used = shares > 0
        open_docs = open_docs[used.sum(axis=1) > 1]
        if not len(open_docs):
            break
        shares = result[open_docs]
        least = np.where(shares > 0, shares, 2.0)
        floor = np.minimum(0.01 / n[open_docs], shares.max(axis=1) / 2)
        drop = (least == least.min(axis=1, keepdims=True)) & (shares < shares.max(axis=1, keepdims=True))
        # languages of equal and largest share: the last by name goes
        tied = ~drop.any(axis=1)
        drop[tied, languages - 1 - np.argmax((shares > 0)[tied, ::-1], axis=1)] = True
        fewer = np.where(drop | (shares < floor[:, None]), 0.0, shares)
        fewer /= fewer.sum(axis=1, keepdims=True)
        words = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in open_docs])
        own_n = n[open_docs]
        first = np.concatenate([[0], np.cumsum(own_n)[:-1]])
        fewer, fit = _em(likelihood[words], first, own_n, fewer)
        penalised = fit - 0.5 * np.log(own_n) * ((fewer > 0).sum(axis=1) - 1)
        better = penalised >= score[open_docs]
        open_docs, fewer, penalised = open_docs[better], fewer[better], penalised[better]
        result[open_docs], score[open_docs] = fewer, penalised
    return result


def _answers(model: Model, logs: list[np.ndarray]) -> list[dict]:
    answers = [
        {"lang_pred": UNKNOWN, "score": 0.0, "languages": [], "shares": []} for _ in logs
    ]
    known = [k for k, own in enumerate(logs) if len(own)]
    if not known or not model.languages:
        return answers
    for k, shares in zip(known, mixtures([logs[k] for k in known]), strict=True):
        order = sorted(np.flatnonzero(shares), key=lambda j: (-shares[j], j))
        answers[k] = {
            "lang_pred": model.languages[order[0]],
            "score": min(1.0, float(shares[order[0]])),
            "languages": [model.languages[j] for j in order],
            "shares": [float(shares[j]) for j in order],
        }
    return answers


def _runs(model: Model, texts: pa.Array) -> Iterator[dict]:
    waiting: list[np.ndarray] = []
    words = 0
    for text in texts:
        waiting.append(word_likelihoods(model, text.as_py() or ""))
        words += len(waiting[-1])
        if words * len(model.languages) >= RUN_CELLS:
            yield from _answers(model, waiting)
            waiting, words = [], 0
    yield from _answers(model, waiting)


def language_mixture(model: Broadcast) -> Callable:
    """A function from a text column to a struct of

    - ``lang_pred``: the language of the largest share, the first by name if shares are equal;
      ``und`` if the text is null or has no letter, or if no language was learned;
    - ``score``: its share of the words, from 0 to 1 (0 for ``und``);
    - ``languages``, ``shares``: all languages of the text, largest share first.

    Texts are read whole; only the text decides. ``model``: a broadcast ``Model``.
    """

    @arrow_udf(RESULT)
    def run(column: pa.Array) -> pa.Array:
        return pa.array(list(_runs(model.value, column)), _TYPE)

    return run
