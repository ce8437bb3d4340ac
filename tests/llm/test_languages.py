"""Languages: accuracy on documents that were not learned from, mixtures, and edge rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rosterlake.llm import language_mix, pretokens, queries


def model_of(spark, rows, parts=3):
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(parts)
    return language_mix.train(frame)


TRAIN = [
    ("en", "the cat sat on the mat and then the other thing with that"),
    ("de", "der hund und die katze schlafen nicht auf dem schönen bett"),
    ("en", "this is what they thought when they were there together"),
    ("de", "ich weiß nicht was soll es bedeuten daß ich so traurig bin"),
    (None, "jjjjj"),
    ("en", None),
]


def mixtures(spark, model, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("found", F.lit(1))
    udf = language_mix.language_mixture(spark.sparkContext.broadcast(model))
    return [r.m for r in frame.select(udf("text").alias("m")).collect()]


def test_held_out_accuracy(spark, folder):
    found = queries.op1_language_mixture(spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in rows)
    assert len(rows) > 40 and right >= 0.97 * len(rows)
    assert found.count() == truth.count()


def test_edge_texts(spark):
    model = model_of(spark, TRAIN)
    assert model.languages == ["de", "en"]
    found = mixtures(spark, model, [None, "", "123 !?", "the", "the katze " * 30, "x" * 4000])
    assert [m.lang_pred for m in found[:3]] == ["und"] * 3 and {m.score for m in found[:3]} == {0.0}
    assert found[3].lang_pred == "en"
    assert found[4].languages == ["de", "en"] or found[4].languages == ["en", "de"]
    assert abs(found[4].score - 0.5) < 0.1
    for m in found[3:]:
        assert abs(sum(m.shares) - 1) < 1e-6 and m.score == m.shares[0]


def test_nothing_learned(spark):
    model = model_of(spark, [(None, "a"), ("en", None)])
    assert model.languages == []
    assert [m.lang_pred for m in mixtures(spark, model, ["hello", None])] == ["und", "und"]


def test_null_ids_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double"
    rows = [(None, "the cat", "en", "s", 1, 0.5), (1, "die katze", "de", "s", 1, 0.5), (1, "die katze", None, "s", 1, 0.5)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/a/documents.parquet")
    found = queries.op1_language_mixture(spark, f"{tmp_path}/a").collect()
    assert len(found) == 3 and not [r for r in found if r.doc_id is None and r.held_out]
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert queries.op1_language_mixture(spark, f"{tmp_path}/b").count() == 0


def plain_em(likelihood, shares, steps=language_mix.EM_STEPS):
    for _ in range(steps):
        joint = likelihood * shares
        shares = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
    return shares, np.log((likelihood * shares).sum(axis=1)).sum()


def plain_mixture(logs):
    """Backward elimination for one document, one language at a time."""
    likelihood, n = np.exp(logs.astype(float)), len(logs)
    shares, fit = plain_em(likelihood, np.full(logs.shape[1], 1 / logs.shape[1]))
    score = fit - 0.5 * np.log(n) * (logs.shape[1] - 1)
    while (shares > 0).sum() > 1:
        fewer = shares.copy()
        fewer[np.argmin(np.where(shares > 0, shares, 2))] = 0
        fewer, fit = plain_em(likelihood, fewer / fewer.sum())
        penalised = fit - 0.5 * np.log(n) * ((fewer > 0).sum() - 1)
        if penalised < score:
            break
        shares, score = fewer, penalised
    return shares


def test_mixtures_of_many_documents_at_once_equal_single_ones():
    rng = np.random.default_rng(1)
    documents = []
    for _ in range(40):
        words, languages = int(rng.integers(1, 60)), 4
        own = rng.integers(0, languages, words) if rng.random() < 0.5 else np.zeros(words, int)
        logs = -rng.gamma(4.0, 1.5, (words, languages))
        logs[np.arange(words), own] = 0
        documents.append(logs.astype(np.float32))
    together = language_mix.mixtures(documents)
    for logs, shares in zip(documents, together):
        assert np.abs(plain_mixture(logs) - shares).max() < 0.02


def test_trigrams_do_not_depend_on_slices(monkeypatch):
    text = "Ein Text über Größe und more words, 12 of them! " * 40
    whole, starts = language_mix.word_trigrams(text)
    monkeypatch.setattr(pretokens, "SLICE_CHARS", 50)
    parts = [language_mix.word_trigrams(p)[0] for p in pretokens.slices(text)]
    assert len(parts) > 5 and np.concatenate(parts).tolist() == whole.tolist()
    assert len(starts) == 40 * 9


def test_tied_languages_go_by_name(spark):
    model = model_of(spark, [("b", "same words here"), ("a", "same words here")])
    found = mixtures(spark, model, ["same words"])[0]
    assert (found.lang_pred, found.score) == ("a", 1.0)
    assert isinstance(pa.array([1]), pa.Array)
