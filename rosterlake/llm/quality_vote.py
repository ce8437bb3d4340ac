"""Quality of texts by weak supervision: rules vote or abstain, expectation-maximisation learns
how far each rule can be trusted, and a document is kept by its posterior probability.

Everything is an expression, an aggregate or a join of Spark. The measures of a text come from
its word array, within the row. The rules' votes make a pattern; there are at most 3^rules of
them, so EM runs over counted patterns, as a fold over one small array, and its answer goes
back to the documents as a small broadcast table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.scratch import store

SPACES = "[\\x20\\x09-\\x0D]+"
_SPACE_CHARS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_ENDS = ".!?"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# Rules, at most: 3^8 = 6,561 patterns.
MAX_RULES = 8
EM_STEPS = 30
# Where EM starts: rules are mostly right and most documents are good.
FIRST_ACCURACY = 0.9
FIRST_PRIOR = 0.8
# A rule is never taken to be worse than chance, nor beyond doubt.
LEAST_ACCURACY, MOST_ACCURACY = 0.55, 0.995
KEEP_FROM = 0.5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by windows of ``window`` words that occur twice or more in the array.

    Windows are compared by a 64-bit hash. Only an array in which one occurs twice is sorted;
    then the union of the windows is measured from start to start.
    """

    def covered(hashes: Column) -> Column:
        ranked = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i")))
        )
        starts = let(
            ranked,
            lambda r: F.sort_array(
                F.transform(
                    F.filter(
                        r,
                        lambda s, k: (F.get(r, k - 1)["h"] == s["h"])
                        | (F.get(r, k + 1)["h"] == s["h"]),
                    ),
                    lambda s: s["i"],
                )
            ),
        )
        nothing = F.struct(F.lit(-2 * window).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            starts,
            nothing,
            lambda acc, i: F.struct(
                i.alias("last"), (acc["n"] + F.least(F.lit(window), i - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    hashes = F.transform(
        F.sequence(F.lit(1), F.size(words) - (window - 1)),
        lambda i: F.xxhash64(F.slice(words, i, window)),
    )
    measured = let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
    )
    return F.when(F.size(words) < window, F.lit(0)).otherwise(measured)


def text_measures(text: Column) -> Column:
    """A struct of whole numbers about a text; null and the empty text measure 0 throughout.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words as in the contract of the
    quality query; n_lines: lines with a word; n_ends: full stops, exclamation and question
    marks; n_distinct: different words.
    """
    text = F.coalesce(text, F.lit(""))
    chars = F.length(text)
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: _without(line, _SPACE_CHARS) != "")
    of_words = let(
        words,
        lambda w: F.struct(
            F.size(w).alias("n_words"),
            F.size(F.array_distinct(w)).alias("n_distinct"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        lines,
        lambda a: F.struct(
            F.size(a).alias("n_lines"), (F.size(a) - F.size(F.array_distinct(a))).alias("n_dup_lines")
        ),
    )
    return let(
        F.struct(of_words.alias("words"), of_lines.alias("lines")),
        lambda m: F.struct(
            m["words"]["n_words"].cast("long").alias("n_words"),
            F.length(_without(text, _SPACE_CHARS)).cast("long").alias("word_chars"),
            (chars - F.length(_without(text, _SYMBOLS))).cast("long").alias("n_symbols"),
            m["lines"]["n_dup_lines"].cast("long").alias("n_dup_lines"),
            m["words"]["n_repeat_words"].cast("long").alias("n_repeat_words"),
            m["lines"]["n_lines"].cast("long").alias("n_lines"),
            (chars - F.length(_without(text, _ENDS))).cast("long").alias("n_ends"),
            m["words"]["n_distinct"].cast("long").alias("n_distinct"),
        ),
    )


@dataclass(frozen=True)
class Rule:
    """Votes good (1) or bad (-1), or abstains (0), by SQL conditions on the measures."""

    name: str
    good: str
    bad: str

    def vote(self, measures: str) -> Column:
        def on(condition: str) -> Column:
            return F.expr(re.sub(r"\b(n_\w+|word_chars)\b", rf"`{measures}`.\1", condition))

        return F.when(on(self.bad), -1).when(on(self.good), 1).otherwise(0)


# Rules must be independent given the quality, so each measures another fault, and one that finds
# nothing abstains: a vote for good that nearly every text gets would be a prior counted twice.
RULES = (
    Rule(
        "symbols",
        good="50 * n_symbols <= n_words and 200 * n_symbols <= word_chars",
        bad="5 * n_symbols > n_words or 25 * n_symbols > word_chars",
    ),
    Rule("sentences", good="false", bad="n_words >= 20 and 60 * n_ends < n_words"),
    Rule(
        "word_length",
        good="false",
        bad="word_chars < 2 * n_words or word_chars > 20 * n_words",
    ),
    Rule("repeated_words", good="false", bad="10 * n_repeat_words > n_words"),
    Rule("repeated_lines", good="false", bad="n_dup_lines >= 2 and 10 * n_dup_lines > 3 * n_lines"),
    Rule("vocabulary", good="false", bad="n_words between 20 and 5000 and 10 * n_distinct < n_words"),
)


def pattern(rules: Sequence[Rule], measures: str) -> Column:
    """The votes as one number: digit vote + 1 in base 3 for each rule, the first rule lowest."""
    code = F.lit(0)
    for k, rule in enumerate(rules):
        code = code + (rule.vote(measures) + 1) * 3**k
    return code.cast("int")


def _fit(patterns: Column, rules: int) -> Column:
    """EM over an array of (votes, n): the patterns with their posterior of being good."""

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)

    def bounded(value: Column) -> Column:
        return F.greatest(F.lit(LEAST_ACCURACY), F.least(F.lit(MOST_ACCURACY), value))

    def weights(state: Column) -> Column:
        """Log odds of good that a vote for good or for bad adds, by rule."""
        return F.zip_with(
            state["good"],
            state["bad"],
            lambda g, b: F.struct(
                F.log(g / (1 - b)).alias("good"), F.log((1 - g) / b).alias("bad")
            ),
        )

    def posteriors(state: Column) -> Column:
        prior = F.log(state["prior"] / (1 - state["prior"]))

        def one(p: Column, w: Column) -> Column:
            odds = total(
                F.zip_with(
                    p["votes"],
                    w,
                    lambda v, x: F.when(v == 1, x["good"]).when(v == -1, x["bad"]).otherwise(0.0),
                )
            )
            return F.struct(
                p["code"].alias("code"),
                p["votes"].alias("votes"),
                p["n"].alias("n"),
                (1 / (1 + F.exp(-(prior + odds)))).alias("posterior"),
            )

        return let(weights(state), lambda w: F.transform(patterns, lambda p: one(p, w)))

    def accuracy(judged: Column, rule: Column, vote: int) -> Column:
        """Of the documents of the class, in expectation, the share on which the rule is right
        when it votes; one document each way is added."""

        def mass(p: Column) -> Column:
            return p["n"] * (p["posterior"] if vote == 1 else 1 - p["posterior"])

        right = total(
            F.transform(judged, lambda p: F.when(F.get(p["votes"], rule) == vote, mass(p)).otherwise(0.0))
        )
        voted = total(
            F.transform(judged, lambda p: F.when(F.get(p["votes"], rule) != 0, mass(p)).otherwise(0.0))
        )
        return bounded((right + FIRST_ACCURACY * 2) / (voted + 2))

    def step(state: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.lit(rules - 1))

        def renewed(judged: Column) -> Column:
            good = total(F.transform(judged, lambda p: p["n"] * p["posterior"]))
            all_docs = total(F.transform(judged, lambda p: p["n"].cast("double")))
            return F.struct(
                ((good + 1) / (all_docs + 2)).alias("prior"),
                F.transform(numbers, lambda j: accuracy(judged, j, 1)).alias("good"),
                F.transform(numbers, lambda j: accuracy(judged, j, -1)).alias("bad"),
            )

        return let(posteriors(state), renewed)

    first = F.struct(
        F.lit(FIRST_PRIOR).alias("prior"),
        F.array_repeat(F.lit(FIRST_ACCURACY), rules).alias("good"),
        F.array_repeat(F.lit(FIRST_ACCURACY), rules).alias("bad"),
    )
    fitted = F.aggregate(F.sequence(F.lit(1), F.lit(EM_STEPS)), first, lambda state, _: step(state))
    return let(
        fitted,
        lambda state: F.struct(state.alias("model"), posteriors(state).alias("patterns")),
    )


def fit_votes(codes: DataFrame, rules: int) -> DataFrame:
    """One row: ``model`` (prior, and by rule its accuracies on good and bad documents) and
    ``patterns`` (code, votes, n, posterior), from a one-column table of vote patterns.

    All patterns meet in one row; there are at most 3^rules, and ``rules`` is at most 8. No
    documents give no row.
    """
    if not 1 <= rules <= MAX_RULES:
        raise ValueError(f"from 1 to {MAX_RULES} rules")
    code = F.col(codes.columns[0])
    counted = codes.groupBy(code.alias("code")).agg(F.count("*").alias("n"))
    votes = F.array(*[(F.floor(F.col("code") / 3**k) % 3 - 1).cast("int") for k in range(rules)])
    rows = F.array_sort(F.collect_list(F.struct("code", votes.alias("votes"), "n")))
    return (
        counted.groupBy()
        .agg(rows.alias("rows"))
        .where(F.size("rows") > 0)
        .select(let(F.col("rows"), lambda r: _fit(r, rules)).alias("fit"))
        .select("fit.*")
    )


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of the table has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def judge(
    docs: DataFrame,
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    drop_text: bool = False,
) -> tuple[DataFrame, str]:
    """The documents, without their texts if ``drop_text``, with one more column, and that column's name: a struct of all measures,
    ``pattern``, ``posterior`` (probability of being good), ``base_failed`` and ``kept``.

    Base rules come first: fewer than MIN_WORDS words, or more than MAX_REPEAT_PERCENT percent
    of them in repeated windows, fail, and have no posterior. EM sees all others, which are
    kept from a posterior of KEEP_FROM on. The text of every document is measured once; with its measures it is written to the shared
    folder, because all votes must be counted before any document is judged. Rows with null or
    repeated ids are judged each on its own. No documents give no rows.
    """
    name = free_name(docs, "quality")
    measured = docs.withColumn(name, text_measures(F.col(text)))
    if drop_text:
        measured = measured.drop(text)
    kept_columns = [c for c in measured.columns if c != name]
    code = free_name(measured, "pattern")
    n_words, n_repeat = F.col(f"`{name}`.n_words"), F.col(f"`{name}`.n_repeat_words")
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    votes = F.when(~failed, pattern(rules, name))
    measured = store(measured.withColumn(code, votes), "measures")
    fitted = fit_votes(measured.select(code).dropna(), len(rules))
    posterior = free_name(measured, "posterior")
    answers = (
        fitted.select(F.explode("patterns").alias("p"))
        .select(F.col("p.code").alias(code), F.col("p.posterior").alias(posterior))
    )
    judged = measured.join(F.broadcast(answers), code, "left").withColumn(
        name,
        F.struct(
            f"`{name}`.*",
            F.col(code).alias("pattern"),
            F.col(posterior).alias("posterior"),
            F.col(code).isNull().alias("base_failed"),
            F.coalesce(F.col(posterior) >= KEEP_FROM, F.lit(False)).alias("kept"),
        ),
    )
    return judged.select(*[f"`{c}`" for c in kept_columns], f"`{name}`"), name
