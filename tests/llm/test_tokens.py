"""Token counts, encoding and packing against the tokenizers library and a plain merge loop."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rosterlake.llm import packing, pair_tree_bpe, pretokens, queries, token_count

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")

EDGE_TEXTS = [
    None,
    "",
    " \n\t ",
    "a",
    "Don't   stop\n\nHE'S 12½ km²!?  ",
    "<|endoftext|>in<|startoftext|> side <|endoftext|",
    "naïve İstanbul ΟΔΟΣ Straße é     x",
    "中文 текст \U0001f600\U0001f600 mixed\x1cwith\x85odd",
    "x" * 3000,
    "ab " * 3000,
]


def expected_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def texts(spark):
    rows = list(enumerate(EDGE_TEXTS)) + [(3, "a"), (None, "no id")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_counts(spark, texts):
    library = pretokens.load(BYTE)
    columns = token_count.count_tokens(texts, BYTE, limit=10)
    clash = texts.withColumn("n_tokens", F.lit("other")).withColumn("word", F.lit(1))
    for row in clash.select("text", *[c.alias(f"{n}_") for n, c in columns.items()]).collect():
        n = len(expected_ids(library, row.text))
        assert (row.n_tokens_, row.over_limit_) == (n, n > 10)
        assert row.n_bytes_ == len((row.text or "").encode())


def test_counts_with_small_caches(monkeypatch):
    monkeypatch.setattr(pretokens, "SLICE_CHARS", 16)
    monkeypatch.setattr(token_count, "CACHE_ENTRIES", 3)
    library = pretokens.load(BYTE)
    counts = token_count._Counts(BYTE)
    counts.known.frequent = {" the": 1}
    for text in EDGE_TEXTS:
        assert counts.of(text or "") == len(expected_ids(library, text))


def test_plain_characters_are_classed_as_by_the_library():
    words, counts = pair_tree_bpe.WordBpe(WORD), token_count._Counts(BYTE)
    codes = [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F)]
    for char in map(chr, codes):
        for text in (f"a{char}B 1{char}2{char}{char}, x {char} '{char}s", f" {char}  {char}\n{char}x"):
            assert words.ids(text) == expected_ids(words.library, text)
            assert counts.of(text) == len(expected_ids(counts.tokenizer, text))


def test_frequent_pretokens_are_merged_over_all_tasks(spark):
    texts = [f"the the the the rare{k}" for k in range(200)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(7)
    found = token_count.frequent_pretokens(frame, entries=5)
    assert " the" in found and len(found) <= 5
    assert token_count.frequent_pretokens(frame.limit(0), entries=5) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=40), st.randoms(use_true_random=False))
def test_pair_tree_merges_like_a_plain_loop(symbols, rng):
    size = 64
    merges, known = {}, list(range(6))
    for rank in range(30):
        left, right = rng.choice(known), rng.choice(known)
        merged = 6 + rank
        if left * size + right not in merges:
            merges[left * size + right] = rank * size + merged
            known.append(merged)
    plain = list(symbols)
    while True:
        pairs = [(merges[a * size + b], k) for k, (a, b) in enumerate(zip(plain, plain[1:])) if a * size + b in merges]
        if not pairs:
            break
        entry, k = min(pairs)
        plain[k : k + 2] = [entry % size]
    assert pair_tree_bpe.merge_symbols(symbols, merges, size) == plain


def test_round_trip_digests(spark, texts):
    library = pretokens.load(WORD)
    found = texts.select("text", pair_tree_bpe.round_trip(WORD)("text").alias("r")).collect()
    assert len(found) == len(EDGE_TEXTS) + 2
    for row in found:
        ids = expected_ids(library, row.text)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.r.n_tokens == len(ids)
        assert row.r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_encode_and_decode_columns(spark, texts):
    library = pretokens.load(WORD)
    ids = texts.select("text", pair_tree_bpe.encode_ids(WORD)("text").alias("ids"))
    for row in ids.select("text", "ids", pair_tree_bpe.decode_ids(WORD)("ids").alias("back")).collect():
        assert row.ids == expected_ids(library, row.text)
        assert row.back == library.decode(row.ids, skip_special_tokens=False)


def test_given_texts_encode_as_the_library_does(spark, folder):
    library, byte = pretokens.load(WORD), pretokens.load(BYTE)
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()
    words, counts = pair_tree_bpe.WordBpe(WORD), token_count._Counts(BYTE)
    for (text,) in texts:
        assert words.ids(text) == expected_ids(library, text)
        assert counts.of(text) == len(expected_ids(byte, text))


def check_packing(rows, documents, capacity):
    """Every id of every document lies in one piece; sequences are gapless and need no padding."""
    library = pretokens.load(WORD)
    left = Counter()
    for doc_id, text in documents:
        ids = np.array([*expected_ids(library, text), 2], "<u4")
        left[(doc_id, len(ids), ids.tobytes())] += 1
    by_document = {}
    for r in rows:
        by_document.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for (doc_id, n), pieces in by_document.items():
        same = [(ids, times) for (d, m, ids), times in left.items() if (d, m) == (doc_id, n)]
        assert sum(p.length for p in pieces) == n * sum(times for _, times in same)
        if sum(times for _, times in same) == 1:
            ids, at = same[0][0], 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at
                assert p.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + p.length)])
                at += p.length
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == capacity or at & (at - 1) == 0 and at < capacity
    assert sum(left.values()) == sum(times for times in left.values())


@pytest.mark.parametrize("capacity, windows, parts", [(16, 3, 20), (64, 4, 5), (4096, 32, 1)])
def test_packing(spark, capacity, windows, parts):
    random.seed(capacity)
    documents = [(k, " ".join(random.choices(["the", "of", "x1"], k=random.randrange(60)))) for k in range(150)]
    documents += [(7, "again"), (None, "no id"), (200, None), (201, "long " * 2000)]
    frame = spark.createDataFrame(documents, "doc_id long, text string").repartition(parts)
    packed = packing.pack(frame.withColumn("ids", F.lit(1)), WORD, capacity=capacity, windows=windows)
    rows = packed.collect()
    check_packing(rows, documents, capacity)
    assert packed.columns == [c.split()[0] for c in packing.PIECE.split(", ")][:-1]


def test_packing_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), WORD).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([], "doc_id long, text string"), WORD, capacity=100)


def test_packing_query(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op2_open_window_packing(spark, folder).collect()
    check_packing(rows, [tuple(d) for d in documents], 4096)


def test_packer_fills_best_and_emits_the_fullest():
    def piece(name, n):
        return packing.Piece(name, 0, memoryview(bytes(4 * n)), n)

    packer = packing.Packer(capacity=8, windows=2)
    assert not list(packer.add(piece(1, 5))) and not list(packer.add(piece(2, 6)))
    assert packer.room == [3, 2]
    full = list(packer.add(piece(3, 2)))  # fills the second window exactly
    assert [[p.doc_id for p in w] for w in full] == [[2, 3]]
    assert not list(packer.add(piece(4, 4)))
    full = list(packer.add(piece(5, 5)))  # fits none: fills up the first, the rest goes on
    assert [[(p.doc_id, len(p)) for p in w] for w in full] == [[(1, 5), (5, 3)]]
    assert sorted(packer.room) == [2]
