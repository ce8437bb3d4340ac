"""Quality votes: the measures, EM and the decisions against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rosterlake.llm import quality_vote, queries

WORD = re.compile(r"[^ \t-\r]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_ends": sum(c in ".!?" for c in text),
        "n_distinct": len(set(words)),
    }


def generated_texts():
    random.seed(4)
    vocabulary = [f"w{k}" for k in range(30)] + ["é|x", "***", "end.", "\U0001f600"]
    texts = [None, "", " \n\t\x0b", "one", "a\n\na\n a\nb", "x" * 50_000, "same " * 5000]
    for _ in range(120):
        words = random.choices(vocabulary, k=random.randrange(90))
        if len(words) > 20 and random.random() < 0.6:
            at, n = random.randrange(len(words) - 12), random.randrange(7, 13)
            words += words[at : at + n] * random.choice([1, 2])
        texts.append("".join(w + random.choice([" ", " ", " ", "\n", "  \t"]) for w in words))
    return texts


def test_measures(spark):
    texts = generated_texts()
    frame = spark.createDataFrame(list(enumerate(texts)), "k long, text string").repartition(3)
    for row in frame.select("k", quality_vote.text_measures(F.col("text")).alias("m")).collect():
        assert row.m.asDict() == plain_measures(texts[row.k]), repr(texts[row.k])[:200]


def plain_fit(counts, rules):
    """EM over (votes, n) as plain loops."""
    prior = quality_vote.FIRST_PRIOR
    good = bad = [quality_vote.FIRST_ACCURACY] * rules

    def posterior(votes):
        odds = math.log(prior / (1 - prior))
        for v, g, b in zip(votes, good, bad):
            odds += {1: math.log(g / (1 - b)), -1: math.log((1 - g) / b), 0: 0.0}[v]
        return 1 / (1 + math.exp(-odds))

    def bounded(x):
        return max(quality_vote.LEAST_ACCURACY, min(quality_vote.MOST_ACCURACY, x))

    for _ in range(quality_vote.EM_STEPS):
        post = {votes: posterior(votes) for votes in counts}
        total = sum(counts.values())
        renewed = []
        for vote in (1, -1):
            accuracies = []
            for j in range(rules):
                mass = {v: n * (post[v] if vote == 1 else 1 - post[v]) for v, n in counts.items()}
                right = sum(m for v, m in mass.items() if v[j] == vote)
                voted = sum(m for v, m in mass.items() if v[j] != 0)
                accuracies.append(bounded((right + 2 * quality_vote.FIRST_ACCURACY) / (voted + 2)))
            renewed.append(accuracies)
        prior = (sum(n * post[v] for v, n in counts.items()) + 1) / (total + 2)
        good, bad = renewed
    return {votes: posterior(votes) for votes in counts}, prior


def code_of(votes):
    return sum((v + 1) * 3**k for k, v in enumerate(votes))


def test_em(spark):
    random.seed(9)
    truth = [(0.9, 0.8), (0.7, 0.9), (0.95, 0.6), (0.8, 0.8)]
    votes = []
    for _ in range(3000):
        is_good = random.random() < 0.75
        row = []
        for on_good, on_bad in truth:
            right = random.random() < (on_good if is_good else on_bad)
            row.append(0 if random.random() < 0.2 else (1 if is_good == right else -1))
        votes.append(tuple(row))
    frame = spark.createDataFrame([(code_of(v),) for v in votes], "code int").repartition(4)
    fit = quality_vote.fit_votes(frame, 4).collect()
    expected, prior = plain_fit(Counter(votes), 4)
    assert len(fit) == 1 and abs(fit[0].model.prior - prior) < 1e-9
    assert abs(prior - 0.75) < 0.05
    assert {tuple(p.votes): p.n for p in fit[0].patterns} == Counter(votes)
    for p in fit[0].patterns:
        assert abs(p.posterior - expected[tuple(p.votes)]) < 1e-9


def test_em_of_nothing(spark):
    assert quality_vote.fit_votes(spark.createDataFrame([], "code int"), 3).count() == 0
    with pytest.raises(ValueError):
        quality_vote.fit_votes(spark.createDataFrame([], "code int"), 9)


def plain_votes(m):
    """The rules once more, as Python conditions."""

    def one(good, bad):
        return -1 if bad else 1 if good else 0

    n, s, c = m["n_words"], m["n_symbols"], m["word_chars"]
    return (
        one(50 * s <= n and 200 * s <= c, 5 * s > n or 25 * s > c),
        one(False, n >= 20 and 60 * m["n_ends"] < n),
        one(False, c < 2 * n or c > 20 * n),
        one(False, 10 * m["n_repeat_words"] > n),
        one(False, m["n_dup_lines"] >= 2 and 10 * m["n_dup_lines"] > 3 * m["n_lines"]),
        one(False, 20 <= n <= 5000 and 10 * m["n_distinct"] < n),
    )


def plain_decisions(texts):
    """(base_failed, kept) by text."""
    measures = [plain_measures(t) for t in texts]
    failed = [m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"] for m in measures]
    votes = [plain_votes(m) for m in measures]
    posterior, _ = plain_fit(Counter(v for v, f in zip(votes, failed) if not f), len(quality_vote.RULES))
    return [(f, not f and posterior[v] >= 0.5) for v, f in zip(votes, failed)]


def test_decisions(spark):
    texts = generated_texts()
    rows = [(k, t, "x", 1, 2.0) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "k long, text string, quality string, pattern int, posterior double")
    judged, name = quality_vote.judge(frame.repartition(3))
    assert name == "_quality" and judged.columns == [*frame.columns, name]
    expected = plain_decisions(texts)
    found = {r.k: (r[name].base_failed, r[name].kept) for r in judged.collect()}
    assert [found[k] for k in range(len(texts))] == expected
    assert judged.count() == len(texts)


def test_no_documents(spark):
    judged, name = quality_vote.judge(spark.createDataFrame([], "doc_id long, text string"))
    assert judged.count() == 0


def test_query(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = dict(zip((d.doc_id for d in documents), plain_decisions([d.text for d in documents])))
    found = queries.op3_quality_votes(spark, folder).collect()
    assert {r.doc_id: (r.base_failed, r.kept) for r in found} == expected
    by_id = {d.doc_id: d.text for d in documents}
    for r in found:
        m = plain_measures(by_id[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == tuple(m.values())[:5]


def test_verdicts_against_labels(spark, folder):
    """The labels are not used in judging: nearly all good documents of enough words are kept, and
    nearly all bad ones go."""
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    found = queries.op3_quality_votes(spark, folder).where("not base_failed").join(labels, "doc_id")
    counts = Counter((r.quality, r.kept) for r in found.collect())
    assert counts[1, True] >= 0.99 * (counts[1, True] + counts[1, False])
    assert counts[0, False] >= 0.9 * (counts[0, True] + counts[0, False])


def test_rules_do_not_repeat_each_other(spark, folder):
    """No two rules cast the same votes wherever one of them finds a fault."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()
    votes = [plain_votes(plain_measures(d.text)) for d in documents]
    rules = range(len(quality_vote.RULES))
    faults = [{k for k, v in enumerate(votes) if v[j] == -1} for j in rules]
    for i in rules:
        for j in range(i):
            both = faults[i] & faults[j]
            assert not both or len(both) < 0.9 * len(faults[i] | faults[j])


def test_no_python_in_the_plan(spark, folder):
    plan = queries.op3_quality_votes(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
