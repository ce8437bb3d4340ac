"""Vector links against all pairs, and the SQL counterparts of both joins."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import oracle, queries
from rosterlake.llm import vector_grid_join as grid
import parity


def plain_links(rows, least):
    """(vec_id, n_links, component_id, kept) of every row, all pairs compared."""
    sound = {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            sound[k] = np.array(v) / max(map(abs, v))
    parent = {k: k for k in range(len(rows))}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for a, x in sound.items():
        for b, y in sound.items():
            width = max(len(x), len(y))
            p, q = np.pad(x, (0, width - len(x))), np.pad(y, (0, width - len(y)))
            if a < b and p @ q / math.sqrt((p @ p) * (q @ q)) >= least:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    smallest = {}
    for k, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            smallest[root(k)] = min(vec_id, smallest.get(root(k), vec_id))
    found = Counter()
    for k, (vec_id, _) in enumerate(rows):
        component = smallest.get(root(k))
        found[(vec_id, links[k], component, vec_id is not None and vec_id == component)] += 1
    return found


def clustered(seed, width, groups=8):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = rng.normal(size=width)
        for _ in range(int(rng.integers(1, 40))):
            noise = rng.choice([0.0, 0.05, 0.2, 0.35])
            rows.append((centre + noise * rng.normal(size=width)).tolist())
    rows += rows[:5] + [(3.0 * np.array(rows[0])).tolist()]
    rows = list(enumerate(rows))
    odd = [None, [], [0.0] * width, [1.0, None], [float("nan")] + [1.0] * (width - 1), [float("inf"), 1.0]]
    rows += [(1000 + k, v) for k, v in enumerate(odd)]
    return rows + [(2000, [1.0]), (2001, [2.0, 0.0]), (2002, [1e-300] + [0.0] * (width - 1)), (None, rows[0][1]), (0, rows[7][1])]


def answers(frame, least=0.9, **more):
    return Counter(tuple(r) for r in grid.link_vectors(frame, least, **more).collect())


@pytest.mark.parametrize("width, least, block", [(2, 0.9, 1024), (6, 0.8, 16), (16, 0.95, 16)])
def test_links(spark, monkeypatch, width, least, block):
    monkeypatch.setattr(grid, "BLOCK_VECTORS", block)
    monkeypatch.setattr(grid, "INTERVAL", 8)
    monkeypatch.setattr(grid, "FAN_OUT", 3)
    rows = clustered(width, width)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    clash = frame.withColumn("cls", F.lit("x")).withColumn("n", F.lit(0)).withColumn("kept", F.lit(1))
    assert answers(clash, least) == plain_links(rows, least)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert grid.link_vectors(empty).count() == 0
    odd = spark.createDataFrame([(1, None), (None, [0.0])], "vec_id long, embedding array<float>")
    assert answers(odd) == Counter({(1, 0, 1, True): 1, (None, 0, None, False): 1})


def test_far_blocks_are_not_paired(spark):
    boxes = [(k, [float(k), 0.0], [k + 0.1, 0.0]) for k in range(40)]
    frame = spark.createDataFrame(boxes, "block long, low array<double>, high array<double>")
    pairs = grid._near_pairs(frame, 40, 1.0, 2).collect()
    assert sorted((r.a, r.b) for r in pairs) == sorted([(k, k) for k in range(40)] + [(k, k + 1) for k in range(39)])


def test_far_dimensions_beyond_the_tree(spark):
    boxes = [(k, [0.0] * 3 + [float(k)], [1.0] * 3 + [k + 0.1]) for k in range(20)]
    frame = spark.createDataFrame(boxes, "block long, low array<double>, high array<double>")
    pairs = grid._near_pairs(frame, 20, 1.0, 2).collect()
    assert sorted((r.a, r.b) for r in pairs) == sorted([(k, k) for k in range(20)] + [(k, k + 1) for k in range(19)])
    one = grid._near_pairs(frame.where("block = 0"), 1, 1.0, 2).collect()
    assert [(r.a, r.b) for r in one] == [(0, 0)]


def test_blocks_end_at_borders_of_cells():
    def rows(*corners):
        return [np.array(c, ">u4").tobytes() for c in corners]

    assert grid._border(rows((1, 1), (1, 1), (1, 1), (1, 1))) == 4
    assert grid._border(rows((1, 1),)) == 1
    assert grid._border(rows(*[(1, 1)] * 6, (1, 2), (2, 0))) == 7  # the first dimension goes before
    assert grid._border(rows((1, 1), (2, 1), (2, 1), (2, 1), (2, 1), (2, 1), (2, 1), (2, 2))) == 7


def test_heads_never_lengthen_a_distance():
    rng = np.random.default_rng(5)
    units = rng.normal(size=(200, 40))
    units /= np.linalg.norm(units, axis=1)[:, None]
    directions = np.linalg.qr(rng.normal(size=(40, 40)))[0][:, :10]
    heads = grid._spots(units, directions)
    for a, b in rng.integers(0, 200, (500, 2)):
        assert np.linalg.norm(heads[a] - heads[b]) <= np.linalg.norm(units[a] - units[b]) + 1e-12


def test_finder_marks_rows_that_have_a_near_one():
    rng = np.random.default_rng(6)
    heads = (rng.normal(size=(90, 4)) * 3).astype(np.float32)
    heads[70:] = heads[:20] + 0.01
    for left, right in ((heads[:60], heads[60:]), (heads, None)):
        one = grid._Block(np.arange(len(left)), left)
        two = one if right is None else grid._Block(np.arange(len(right)), right)
        finder = grid._Finder(one, two, 0.5)
        finder.interval = 8
        finder.run()
        apart = np.linalg.norm(one.heads[:, None] - two.heads[None], axis=2)
        if right is None:
            np.fill_diagonal(apart, 9)
        assert (finder.near[0] == (apart <= 0.5).any(axis=1)).all()
        assert (finder.near[1] == (apart <= 0.5).any(axis=0)).all()


def test_separate_groups_skip_blocks_and_fetch_few_vectors(spark, monkeypatch, tmp_path):
    """Groups in different corners: most pairs of blocks are skipped, and only rows with another
    one near are fetched."""
    monkeypatch.setattr(grid, "BLOCK_VECTORS", 16)
    monkeypatch.setattr(grid, "store", lambda df, name: _store(spark, df, name, tmp_path))
    rng = np.random.default_rng(7)
    rows = []
    for k in range(10):
        centre = np.eye(10)[k]
        rows += [(100 * k + i, (centre + 0.02 * rng.normal(size=10)).tolist()) for i in range(40)]
    lone = [np.arange(10.0) - 4.5, 4.5 - np.arange(10.0)]
    rows += [(5000 + i, v.tolist()) for i, v in enumerate(lone)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert answers(frame) == plain_links(rows, 0.9)
    blocks = spark.read.parquet(str(tmp_path / "blocks")).count()
    pairs = spark.read.parquet(str(tmp_path / "pairs")).count()
    assert pairs < 0.5 * blocks * (blocks + 1) / 2
    near = spark.read.parquet(str(tmp_path / "near"))
    assert near.select("cls").distinct().count() == 400


def _store(spark, df, name, folder):
    df.write.parquet(str(folder / name))
    return spark.read.schema(df.schema).parquet(str(folder / name))


def test_ids_may_be_texts(spark):
    rows = [("b", [1.0, 0.0]), ("a", [1.0, 0.01]), ("c", [0.0, 1.0]), (None, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    assert answers(frame) == Counter(
        {("a", 2, "a", True): 1, ("b", 2, "a", False): 1, (None, 2, "a", False): 1, ("c", 0, "c", True): 1}
    )


def test_queries_against_sql(spark, folder):
    con = parity.connect(folder)
    for name in ("op7_grid_order_join", "op10_parity_sketch_join"):
        parity.assert_same(queries.QUERIES[name](spark, folder), con, oracle.ORACLES[name])
    con.close()
