"""From raw documents to packed training sequences, in stages that are stored one by one.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of ``documents``; other columns of the input pass through them too.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm import language_mix, packing, parity_join, quality_vote, secret_scan
from rosterlake.llm.scratch import store

# A document in which no language has half of the words has no language of its own.
LEAST_SHARE = 0.5
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def keep_one_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language. It is learned from all labelled documents; those without
    a letter, and those of which no language makes up half, go."""
    model = spark.sparkContext.broadcast(language_mix.train(docs.select("lang", "text")))
    found = quality_vote.free_name(docs, "found")
    mixture = language_mix.language_mixture(model).asNondeterministic()
    judged = docs.withColumn(found, mixture("text"))
    share, name = F.col(f"`{found}`.score"), F.col(f"`{found}`.lang_pred")
    return judged.where((name != language_mix.UNKNOWN) & (share >= LEAST_SHARE)).drop(found)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged, name = quality_vote.judge(docs)
    return judged.where(F.col(f"`{name}`.kept")).drop(name)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (shingles of five words, similarity 0.8): the one
    with the smallest id, rows without an id last; of equal ids the one that comes first by hashes
    of the row. Texts without a word are in no group. Rows that share id and text are one document,
    of which one row stays; rows that share only an id are told apart."""
    columns = [f"`{c}`" for c in docs.columns]
    key, row = quality_vote.free_name(docs, "key"), quality_vote.free_name(docs, "row")
    # maps have no hash
    hashed = [f"`{c}`" for c, t in docs.dtypes if "map<" not in t and "variant" not in t]
    # a missing id and a missing text have to differ from each other
    of_text = F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull())
    keyed = docs.withColumns({key: of_text, row: F.xxhash64(*hashed)})
    texts = keyed.select(F.col(key).alias("doc_id"), "text")
    linked = parity_join.link_texts(texts, k=SHINGLE_WORDS, num=SIMILAR_PERCENT)
    linked = linked.select(F.col("doc_id").alias(key), "component_id").distinct()
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", key, row)
    firsts = keyed.groupBy(key).agg(F.min(rank).alias("first"), F.count("*").alias("rows"))
    grouped = store(firsts.join(linked, key), "grouped")
    groups = grouped.groupBy("component_id").agg(F.min("first").alias("first"), F.sum("rows").alias("rows"))
    firsts = groups.select(F.col(f"first.{key}").alias(key), F.col(f"first.{row}").alias(row))
    # a row that is alone in its group stays where it is; the others, few or many, meet the firsts
    several = groups.where("rows > 1").select("component_id")
    in_doubt = grouped.select(key, "component_id").join(several.hint("rebalance"), "component_id")
    mark = quality_vote.free_name(keyed, "mark")
    judged = parity_join.with_mark(keyed, in_doubt.select(key), [key], mark)
    met = judged.where(F.col(mark)).join(firsts, [key, row], "left_semi").dropDuplicates([key, row])
    return judged.where(~F.col(mark)).select(*columns).unionByName(met.select(*columns))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; ``n_chars`` follows the text."""
    columns = list(docs.columns)
    redacted = docs.withColumn("text", secret_scan.redact_secrets().asNondeterministic()("text"))
    if "n_chars" in columns:
        redacted = redacted.withColumn("n_chars", F.length("text").cast("long"))
    return redacted.select(*[f"`{c}`" for c in columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", keep_one_language),
    ("quality", keep_good_quality),
    ("near_duplicates", keep_one_of_group),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# Languages, votes and packing are iterative; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
