"""The pipeline: each stage against a plain version on its own input, and edge rows."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import corpus_pipeline as pipeline
from rosterlake.llm import secret_scan
from test_parity_join import plain_set
from test_quality import plain_decisions
from test_tokens import check_packing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, folder):
    """The output of every stage on the given documents, the input first."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = [docs.collect()]
    for name, stage in pipeline.STAGES:
        result = stage(spark, docs, folder)
        if name != pipeline.STAGES[-1][0]:
            assert result.dtypes == docs.dtypes
            docs = pipeline.store(result, name)
            result = docs
        found.append(result.collect())
    return found


def test_order():
    assert [name for name, _ in pipeline.STAGES] == ["language", "quality", "near_duplicates", "secrets", "packing"]
    assert pipeline.ORACLE_SQL is None
    assert "pipeline" in spark_entry.queries()


def test_language_stage_keeps_texts_of_one_language(stages):
    before, after = stages[0], stages[1]
    kept = {r.doc_id for r in after}
    assert [r for r in after if r not in before] == []
    for r in before:
        if r.doc_id not in kept:
            assert not any(c.isalpha() for c in r.text) or len(r.text) < 200
    assert len(after) >= 0.97 * len(before)


def test_quality_stage(stages):
    before, after = stages[1], stages[2]
    decisions = plain_decisions([r.text for r in before])
    assert Counter(after) == Counter(r for r, (_, kept) in zip(before, decisions) if kept)
    assert 0 < len(after) < len(before)


def test_near_duplicate_stage(stages):
    before, after = stages[2], stages[3]
    sets = {r.doc_id: plain_set(r.text, 5) for r in before}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and x and y:
                shared = len(x & y)
                if 100 * shared >= 80 * (len(x) + len(y) - shared):
                    a_root, b_root = root(a), root(b)
                    parent[max(a_root, b_root)] = min(a_root, b_root)
    assert Counter(after) == Counter(r for r in before if root(r.doc_id) == r.doc_id)
    assert len(after) < len(before)


def test_secret_stage(stages):
    before, after = stages[3], stages[4]
    by_id = {r.doc_id: r for r in after}
    assert len(by_id) == len(before)
    changed = 0
    for r in before:
        spans = secret_scan.base_spans(r.text) + secret_scan.confirmed_spans(r.text)
        found = by_id[r.doc_id]
        assert (found.text == r.text) == (not spans)
        assert not secret_scan.base_spans(found.text) and found.n_chars == len(found.text)
        assert (found.lang, found.source) == (r.lang, r.source)
        changed += bool(spans)
    assert changed


def test_packing_stage(stages):
    check_packing(stages[5], [(r.doc_id, r.text) for r in stages[4]], 4096)


def test_run_is_all_stages(spark, folder, stages):
    found = spark_entry.queries()["pipeline"](spark, folder)
    assert Counter((r.doc_id, r.doc_tokens) for r in found.collect() if r.start == 0) == Counter(
        (r.doc_id, r.doc_tokens) for r in stages[5] if r.start == 0
    )


@pytest.mark.parametrize("parts", [1, 5])
def test_near_duplicates_of_rows_with_equal_or_missing_ids(spark, folder, parts):
    def text(name):
        return " ".join(f"{name}{k}" for k in range(60))

    rows = [
        (1, text("a"), "x"),
        (7, text("a") + " more", "x"),  # a near copy of row 1 ...
        (7, text("b"), "x"),  # ... shares its id with a text of its own
        (8, text("c"), "x"),
        (8, text("d"), "x"),
        (8, text("d"), "x"),
        (9, text("e"), "y"),
        (9, text("e"), "x"),
        (None, text("a"), "x"),
        (None, text("f"), "x"),
        (None, text("f"), "x"),
        (None, text("g"), "x"),
        (10, None, "x"),
        (11, "", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(parts)
    docs = docs.withColumn("tags", F.create_map(F.lit("k"), F.lit(1)))
    result = pipeline.keep_one_of_group(spark, docs, folder)
    assert result.dtypes == docs.dtypes
    found = Counter((r.doc_id, r.text) for r in result.collect())
    assert found == Counter(
        [(1, text("a")), (7, text("b")), (8, text("c")), (8, text("d")), (9, text("e"))]
        + [(None, text("f")), (None, text("g")), (10, None), (11, "")]
    )


def test_edge_rows(spark, folder):
    good = "This is a sentence of words that differ, and it ends well. " * 2
    words = " ".join(f"{w}{k}" for k in range(30) for w in ("the", "house", "and")) + "."
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, words, "en", None, 9),
        (3, words, "en", None, 9),
        (None, words, None, "a", 9),
        (None, "12 34 !!", "en", "a", 9),
        (4, words + " password=abcdefghijklmnop", "en", "a", 9),
        (5, good, "en", "a", 9),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("quality", F.lit("x")).withColumn("found", F.lit(1))
    for _, stage in pipeline.STAGES[:-1]:
        result = stage(spark, docs, folder)
        assert result.columns == docs.columns
        docs = pipeline.store(result, "edge")
    left = docs.collect()
    assert {r.doc_id for r in left} <= {3, 4, 5, None} and sum(r.doc_id == 3 for r in left) == 1
    assert all(not secret_scan.base_spans(r.text) for r in left)
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
