"""Near-duplicate groups against exact comparison of all pairs, and the parts of the join."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import parity_join, shingles
from rosterlake.llm.components import _with_least, connected_components

WORD = re.compile(r"[^ \t-\r]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def plain_groups(rows, k, num, den=100):
    """(doc_id, n_shingles, component_id) of each row, all pairs compared."""
    sets = [plain_set(text, k) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            shared = len(a & b)
            if a and b and den * shared >= num * (len(a) + len(b) - shared):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return Counter(
        (doc_id, len(sets[i]), least.get(root(i)) if sets[i] else doc_id)
        for i, (doc_id, _) in enumerate(rows)
    )


def near_copies(seed, groups=12):
    random.seed(seed)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(groups):
        base = random.choices(words, k=random.choice([1, 3, 4, 8, 20, 50, 120, 300]))
        for _ in range(random.choice([1, 2, 6, 15])):
            copy = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 3, 6])):
                edit, at = random.choice("cdi"), random.randrange(len(copy) + 1)
                if edit == "i":
                    copy.insert(at, random.choice(words))
                elif at < len(copy):
                    copy[at : at + 1] = [] if edit == "d" else [random.choice(words)]
            texts.append(random.choice([" ", "\n", " \t "]).join(copy))
    texts += ["", None, "  \n", "Same Text", "same text", "common line " * 3, "common line " * 4]
    random.shuffle(texts)
    return [(k, t) for k, t in enumerate(texts)]


def answers(frame, k, num):
    return Counter(tuple(r) for r in parity_join.link_texts(frame, k, num).collect())


@pytest.mark.parametrize("k, num", [(4, 85), (5, 80), (1, 50)])
def test_groups(spark, k, num):
    rows = near_copies(num)
    rows += [(None, "same text"), (3, "same text"), (3, rows[5][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    clash = frame.withColumn("part", F.lit("x")).withColumn("cls", F.lit(0)).withColumn("n", F.lit(1))
    assert answers(clash, k, num) == plain_groups(rows, k, num)


def test_groups_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(parity_join, "BLOCK_CLASSES", 4)
    rows = near_copies(1, groups=8)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert answers(frame, 4, 85) == plain_groups(rows, 4, 85)


def test_texts_without_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert parity_join.link_texts(empty, 4, 85).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (None, " ")], "doc_id long, text string")
    assert answers(blank, 4, 85) == Counter({(1, 0, 1): 1, (2, 0, 2): 1, (None, 0, None): 1})


@pytest.mark.parametrize("stretch", [1 << 20, 5, 64])
def test_shingle_sets(monkeypatch, stretch):
    monkeypatch.setattr(shingles, "STRETCH", stretch)
    random.seed(stretch)
    texts = [
        None if random.random() < 0.05 else "".join(random.choices("abAB \n\té\x85", k=random.choice([0, 1, 9, 80])))
        for _ in range(150)
    ]
    for k in (1, 4):
        sets, bounds = shingles.shingle_sets(pa.array(texts, pa.string()).slice(2), k)
        mine = [frozenset(sets[a:b].tolist()) for a, b in zip(bounds, bounds[1:])]
        plain = [plain_set(t, k) for t in texts[2:]]
        for a, x in zip(mine, plain):
            for b, y in zip(mine, plain):
                assert len(a & b) == len(x & y)
        numbers = shingles.set_hashes(sets, bounds).tolist()
        assert len(set(numbers)) == len(set(plain))
        assert {n == 0 for n, p in zip(numbers, plain) if not p} <= {True}


@pytest.mark.parametrize("num", [50, 80, 85, 99, 100])
def test_bands_hold_every_link(num):
    bands = parity_join.Bands(num, 100, 400)
    for a in range(1, 400):
        band = int(bands.of(np.array([a]))[0])
        for b in range(a, a * 100 // num + 1):
            other = int(bands.of(np.array([b]))[0])
            assert other in (band, band + 1) and b <= bands.reach[band]
            most = max(s for s in range(b - a, a + b + 1) if 100 * (a + b - s) >= num * (a + b + s))
            assert most == bands.difference(a, b)
            assert bands.words[band] == 0 if most < 1 and bands.words[band] == 0 else most < bands.words[band]


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(3)
    bands = parity_join.Bands(85, 100, 600)
    for size in (6, 8, 20, 60, 150, 400):
        for _ in range(60):
            base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            drop, add = rng.integers(0, size // 7 + 2, 2)
            other = np.concatenate([base[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)])
            shared = len(base) - drop
            if 100 * shared < 85 * (size + add) or not len(other) or drop + add == 0:
                continue
            sets = np.concatenate([np.sort(base), np.sort(other)])
            keys, owners = parity_join.sketch_keys(sets, np.array([0, size, size + len(other)]), bands)
            assert set(keys[owners == 0].tolist()) & set(keys[owners == 1].tolist())


def test_parity_sketch_bounds_the_difference():
    rng = np.random.default_rng(5)
    a = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    b = np.unique(np.concatenate([a[20:], rng.integers(0, 1 << 63, 30, dtype=np.uint64)]))
    one, two = parity_join._sketches([a, b], 1024)
    differ = int(np.bitwise_count(one ^ two).sum())
    assert 0 < differ <= len(np.setxor1d(a, b))


def test_components(spark):
    random.seed(2)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(220)]
    edges += [(1000 + k, 1001 + k) for k in range(60)] + [(5000, k) for k in range(5001, 5100)]
    edges += [(7, 7), (None, 3), (3, None)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {x: root(x) for x in list(parent)}
    assert len(found) == len(parent)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edges_of_one_node_are_split(spark):
    """A third of all edges at one node, as the lower and as the upper end."""
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        n = F.col("id")
        for lo, hi, of, at in (
            (F.when(n % 3 == 0, 0).otherwise(n), n + 100_000, "hi", "lo"),
            (n, F.when(n % 3 == 0, 500_000).otherwise(n + 100_000), "hi", "hi"),
        ):
            edges = spark.range(0, 60_000, 1, 16).select(lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
            joined = _with_least(edges.repartition(16), of, at)
            parts = joined.select(F.spark_partition_id().alias("p"), F.hash(*joined.columns).alias("h"))
            sizes = [r.n for r in parts.groupBy("p").agg(F.count("*").alias("n"), F.max("h")).collect()]
            assert sum(sizes) == 60_000 and max(sizes) / sum(sizes) < 0.15
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
