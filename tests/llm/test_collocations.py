"""Collocations against plain counting, with shards from a few words up."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import collocations as col, oracle, queries
from parity import assert_same, connect

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows) -> dict:
    """language -> phrase of up to four words -> count; the empty phrase counts words."""
    found = defaultdict(Counter)
    for text, lang in rows:
        of_lang = found["und" if lang is None else lang]
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            of_lang[()] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    of_lang[tuple(words[i : i + size])] += 1
    return found


def plain(rows, max_words=3, support=10, top=2000, covered=50) -> list[tuple]:
    found = []
    for lang, count in plain_counts(rows).items():
        wanted = {p: a for p, a in count.items() if 1 < len(p) <= max_words and a >= support}
        longer = Counter()
        for phrase, a in wanted.items():
            for size in range(2, len(phrase)):
                for i in range(len(phrase) - size + 1):
                    inner = phrase[i : i + size]
                    longer[inner] = max(longer[inner], a)
        rows_of = []
        for p, a in wanted.items():
            if longer[p] and 100 * longer[p] >= covered * a:
                continue
            cuts = ((count[p[:k]], count[p[k:]], k) for k in range(1, len(p)))
            score, _, l, r = min((1_000_000 * a * a // (l * r), k, l, r) for l, r, k in cuts)
            rows_of.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows_of)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, count[()], -score))
    return sorted(found)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    parts = ["a", "B", "é ", " ", "  ", "\t", "b ", "C ", "x", ".", " a b c ", "\n", "longerthaneight "]
    texts = ["".join(draw.choices(parts, k=draw.randrange(40))) for _ in range(250)]
    some = [(draw.choice([t, t, t, None, ""]), draw.choice(["en", "en", "fr", None, "und", ""])) for t in texts]
    # a long text, a language of its own in one shard, repeated rows
    return some + [(" a b c. d" * 2000 + "y" * 500, "zz")] + [("Same words here", "en")] * 12


@pytest.mark.parametrize(
    "bounds, max_words, support",
    [
        (col.Bounds(), 3, 10),
        (col.Bounds(64, 200, 100, 1), 3, 10),
        (col.Bounds(7, 50, 30, 3000), 4, 3),
        (col.Bounds(64, 1 << 20, 1 << 20, 1 << 26), 2, 1),
    ],
)
def test_against_plain_counting(spark, rows, bounds, max_words, support):
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    docs = docs.withColumn("phrase", F.lit("clash"))
    found = col.collocations(docs, max_words, support, bounds=bounds)
    assert sorted(map(tuple, found.collect())) == plain(rows, max_words, support)


def test_counts_and_limits(spark, rows):
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    counts = col.frequent_phrases(docs, 2, 4)
    found = {(r.lang, r.phrase): (r.size, r.f) for r in counts.collect()}
    wanted = {
        (lang, " ".join(p)): (len(p), f)
        for lang, of_lang in plain_counts(rows).items()
        for p, f in of_lang.items()
        if not p or len(p) <= 2 and f >= 4
    }
    assert found == wanted
    few = col.collocations(docs, top=2, covered_percent=101)
    assert sorted(map(tuple, few.collect())) == plain(rows, top=2, covered=101)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert col.collocations(docs).count() == 0
    docs = spark.createDataFrame([(None, None), (".. ,", "en")], "text string, lang string")
    assert col.collocations(docs, support=1).count() == 0


def test_what_a_shard_keeps_stays_below_the_support():
    known = col._Known(10, 3, ("en", "fr"), (1000, 10), col.Bounds())
    for shares in ([1000], [500, 500], [1] * 1000, [333, 333, 334], [990] + [1] * 10, [101] * 9 + [91]):
        assert sum(shares) == 1000
        assert sum(known.kept(0, size) for size in shares) < 10
    assert known.kept(0, 1000) == 9 and known.kept(-1, 1000) == 0


def test_scores_beyond_64_bits(spark):
    a, l, r = 9_007_199_254_740_993, 9_007_199_254_740_997, 9_007_199_254_741_001
    rows = [("en", 2, "p q", a), ("en", 1, "p", l), ("en", 1, "q", r), ("en", 0, "", 3 * r)]
    phrases = spark.createDataFrame(rows, "lang string, size int, phrase string, f long")
    found = col.scored(phrases).first()
    assert (found.score, found.l, found.r) == (1_000_000 * a * a // (l * r), l, r)


def test_hashes_tell_words_apart():
    words = sorted({w for n in (1, 7, 8, 9, 16, 17) for w in (b"a" * n, b"a" * (n - 1) + b"b", b"b" * n)})
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    assert len(set(col._Hash(0).words(data, starts, ends).tolist())) == len(words)


def test_query(spark, folder):
    found = queries.op12_partitioned_collocations(spark, folder)
    assert_same(found, connect(folder), oracle.ORACLES["op12_partitioned_collocations"])
