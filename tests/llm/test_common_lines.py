"""Lines that many texts share: what they bring together, and what is sent on their account."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from rosterlake.llm import parity_join
from test_parity_join import answers, near_copies, plain_groups


def texts_with_lines(n, lines=6, words=45):
    """Texts of words of their own, each with one of a few lines; every tenth is followed by a
    near copy."""
    random.seed(n)
    shared = [" ".join(f"line{k}x{j}" for j in range(12)) for k in range(lines)]
    rows = []
    while len(rows) < n:
        own = [f"w{random.randrange(10**6)}" for _ in range(words)]
        at = random.randrange(words)
        line = random.choice(shared)
        rows.append(" ".join([*own[:at], line, *own[at:]]))
        if len(rows) % 10 == 0:
            rows.append(" ".join([*own[:at], line, *own[at:-1]]))
    return list(enumerate(rows))


def test_common_lines_join_no_bag(spark, monkeypatch):
    stored = {}

    def record(df, name, store=parity_join.store):
        stored[name] = store(df, name)
        return stored[name]

    monkeypatch.setattr(parity_join, "store", record)
    rows = texts_with_lines(3000)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert parity_join.link_texts(frame, 5, 80).count() == len(rows)
    bags = Counter(r.bag for r in stored["chosen"].collect())
    assert sum(n == 2 for n in bags.values()) > 200  # the near copies
    assert max(bags.values()) < 60


@pytest.mark.parametrize("k, num", [(5, 80), (2, 60)])
def test_groups_among_common_lines(spark, k, num):
    rows = [text for _, text in texts_with_lines(250, lines=2)] + [text for _, text in near_copies(4, 6)]
    rows = list(enumerate(rows))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert answers(frame, k, num) == plain_groups(rows, k, num)


@pytest.mark.parametrize("num", [50, 80, 85])
def test_linked_sets_share_more_keys_than_they_leave_out(num):
    rng = np.random.default_rng(num)
    bands = parity_join.Bands(num, 100, 900)
    tried = 0
    for size in (5, 8, 13, 20, 60, 150, 600):
        for _ in range(60):
            base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            drop, add = rng.integers(0, size // 3 + 2, 2)
            shared = size - drop
            if 100 * shared < num * (size + add) or drop + add == 0:
                continue
            other = np.concatenate([base[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)])
            sets = np.concatenate([np.sort(base), np.sort(other)])
            bounds = np.array([0, size, size + len(other)])
            keys, owners, sides = parity_join.sided_keys(sets, bounds, bands)
            found = {(s, x): set(keys[(owners == s) & (sides == x)].tolist()) for s in (0, 1) for x in (0, 1)}
            own = [int(b) for b in bands.of(np.diff(bounds))]
            band = min(own)
            met = found[0, own[0] - band] & found[1, own[1] - band]
            assert len(met) > bands.late[band]
            tried += 1
    assert tried > 50


def test_the_most_common_keys_are_left_out(spark):
    bands = parity_join.Bands(80, 100, 200)
    band = int(bands.of(np.array([100]))[0])
    late, below = bands.late[band], bands.late[band - 1]
    assert late > 1 and below > 1
    keys = [(7, key, holders, side) for side in (0, 1) for key, holders in enumerate(range(2, 40), 100 * side)]
    keys += [(8, 5, 9, 0)]  # a set so small that it leaves out nothing
    shared = spark.createDataFrame(keys, "node long, key long, holders long, side long").repartition(5)
    classes = spark.createDataFrame([(7, 100), (7 + (1 << 45), 150), (8, 1)], "cls long, n long")
    found = parity_join._kept_keys(shared, classes, bands).collect()
    kept = {(r.node, r.key) for r in found}
    assert len(found) == len(kept)
    assert kept == {(8, 5), *((7, key) for key in range(38 - late)), *((7, 100 + key) for key in range(38 - below))}


def test_keys_are_packed_whole():
    rng = np.random.default_rng(1)
    for n in (1, 5, 300):
        low = np.sort(rng.integers(0, 1 << parity_join.LOW_BITS, n, dtype=np.uint64))
        low[-1] = (1 << parity_join.LOW_BITS) - 1
        nodes = rng.integers(0, 1 << parity_join.NODE_BITS, n, dtype=np.uint64)
        nodes[0] = (1 << parity_join.NODE_BITS) - 1
        sides = rng.integers(0, 2, n).astype(np.uint8)
        packed = parity_join.pack(low, nodes, sides)
        assert len(packed) <= 9.2 * n + 65
        for mine, plain in zip(parity_join.unpack(packed), (low, nodes, sides), strict=True):
            assert mine.tolist() == plain.tolist()


def test_marks_leave_out_no_wanted_row(spark):
    rows = spark.range(0, 20_000, 1, 4).withColumnRenamed("id", "x")
    rows = rows.withColumn("x", F.when(F.col("x") == 3, None).otherwise(F.col("x")))
    wanted = rows.where("x % 100 = 0 or x is null")
    marked = parity_join.with_mark(rows, wanted, ["x"], "m")
    assert marked.columns == ["x", "m"] and marked.count() == 20_000
    found = {r.x for r in marked.where("m").collect()}
    assert {None, *range(0, 20_000, 100)} <= found and len(found) < 400


def test_texts_alone_in_their_group_are_not_shuffled(spark, folder, monkeypatch):
    sent = []
    mark = parity_join.with_mark

    def record(rows, wanted, on, name):
        found = mark(rows, wanted, on, name)
        if "lang" in rows.columns:
            sent.append(found.where(F.col(name)).count())
        return found

    monkeypatch.setattr(parity_join, "with_mark", record)
    rows = [(k, text, "x") for k, text in texts_with_lines(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    result = pipeline.keep_one_of_group(spark, docs, folder)
    groups = plain_groups([r[:2] for r in rows], 5, 80)
    assert {r.doc_id for r in result.collect()} == {least for _, _, least in groups}
    copies = len(rows) - len({least for _, _, least in groups})
    assert copies > 30 and sent and sent[0] <= 2 * copies + 5
