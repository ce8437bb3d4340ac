"""Reputation of hosts by empirical Bayes, and URL rules that go before it.

Labelled page outcomes are counted by host, registered domain and suffix. Each level is shrunk
towards the level above by a beta prior: a suffix towards all pages, a domain towards its
suffix, a host towards its domain. How strong a prior is follows from how much the rates of
that level differ beyond chance (beta-binomial moments). A host is blocked if even the lower
bound of its posterior rate of bad pages is above a limit. A host without outcomes has its prior
as posterior: that of its domain, else of its suffix, else the rate of all pages.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Suffix rules where a caller gives none; a suffix without a rule has one label.
SUFFIX_RULES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")
# Rules of a file, at most; they are part of the plan.
MOST_SUFFIX_RULES = 20_000
BLOCK_ABOVE = 0.5
# Standard deviations below the mean: some 95 percent of the posterior lie above the bound.
DEVIATIONS = 1.645
# Limits of the correlation within a level, so that a prior weighs from 3 to 999 pages and
# a single bad page condemns no host.
LEAST_CORRELATION, MOST_CORRELATION = 0.001, 0.25


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` is host and path prefix, as ``org/`` or ``example.org/en/1``."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


# Fixed values of the URL query.
RULES = (
    UrlRule("allow", "org/"),
    UrlRule("block", "example.org/es/"),
    UrlRule("block", "example.org/en/1"),
    UrlRule("allow", "com/fr/"),
    UrlRule("block", "com/de/"),
)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case. Empty
    for null and for a text without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> tuple[Column, Column]:
    """Pattern and verdict of the longest rule that fits; null if none does. A rule fits its
    host and all hosts below it, if the path begins with the rule's path."""
    pattern = verdict = None
    for rule in sorted(rules, key=lambda r: (-len(r.pattern), r.pattern)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        then, so = F.lit(rule.pattern), F.lit(rule.verdict)
        pattern = F.when(fits, then) if pattern is None else pattern.when(fits, then)
        verdict = F.when(fits, so) if verdict is None else verdict.when(fits, so)
    none = F.lit(None).cast("string")
    return (none, none) if pattern is None else (pattern, verdict)


def read_suffix_rules(spark: SparkSession, path: str) -> list[str]:
    """The rules of a public list of suffixes: one in each line, up to the first white space;
    empty lines and lines that begin with ``//`` hold none. More than MOST_SUFFIX_RULES are refused."""
    line = F.lower(F.regexp_extract("value", r"^\s*(\S*)", 1))
    rules = spark.read.text(path).select(line.alias("rule"))
    rules = rules.where((F.col("rule") != "") & ~F.col("rule").startswith("//")).distinct()
    found = [row.rule for row in rules.limit(MOST_SUFFIX_RULES + 1).collect()]
    if len(found) > MOST_SUFFIX_RULES:
        raise ValueError(f"more than {MOST_SUFFIX_RULES} suffix rules in {path}")
    return sorted(found)


def _suffix_labels(name: Column, rules: Sequence[str]) -> Column:
    """How many labels the suffix of a name has. The rule of most labels decides: ``co.uk`` is a
    suffix, ``*.ck`` makes one of any label before ``ck``, and ``!www.ck`` goes before all others
    and says that ``www.ck`` is none: its suffix is shorter by a label. One label without a rule."""
    exceptions: dict[int, list[str]] = {}
    others: dict[int, tuple[list[str], list[str]]] = {}
    for rule in rules:
        rule = rule.strip(".")
        labels = rule.count(".") + 1
        if rule.startswith("!"):
            exceptions.setdefault(labels, []).append(rule[1:])
        elif rule.startswith("*."):
            others.setdefault(labels, ([], []))[1].append(rule[2:])
        else:
            others.setdefault(labels, ([], []))[0].append(rule)
    size = F.size(F.split(name, r"\."))
    cases = [
        (F.substring_index(name, ".", -labels).isin(*exceptions[labels]), labels - 1)
        for labels in sorted(exceptions, reverse=True)
    ]
    for labels in sorted(others, reverse=True):
        exact, wild = others[labels]
        fits = F.substring_index(name, ".", -labels).isin(*exact) if exact else F.lit(False)
        if wild:
            fits = fits | ((size >= labels) & F.substring_index(name, ".", 1 - labels).isin(*wild))
        cases.append((fits, labels))
    answer = F.when(F.lit(False), 1)
    for fits, labels in cases:
        answer = answer.when(fits, labels)
    return answer.otherwise(1)


def host_levels(host: Column, suffix_rules: Sequence[str] = SUFFIX_RULES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, without a port: the suffix by the rules, the domain
    with one label more. Addresses of numbers, single names and suffixes alone are domains of
    their own."""
    name = F.regexp_replace(host, r":\d*$", "")
    is_number = name.rlike(r"^(\d+(\.\d+){3}|\[.*\])$")
    backwards = F.reverse(F.split(name, r"\."))
    labels = _suffix_labels(name, suffix_rules)

    def last(count: Column) -> Column:
        return F.when(is_number, name).otherwise(
            F.array_join(F.reverse(F.slice(backwards, F.lit(1), count)), ".")
        )

    return last(labels + 1), last(labels)


def _strength(counts: DataFrame) -> tuple[float, float]:
    """Rate of all pages, and the weight in pages of a prior for the groups in ``counts``."""
    row = counts.agg(
        F.sum("n").alias("n"),
        F.sum("bad").alias("bad"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("squares"),
        F.sum(F.col("n") * F.col("n").cast("double")).alias("sizes"),
        F.count("*").alias("groups"),
    ).first()
    if not row.n:
        return 0.0, 1.0 / MOST_CORRELATION - 1
    rate = row.bad / row.n
    spread = rate * (1 - rate)
    free = row.groups - 1
    between = spread * (row.n - row.sizes / row.n - free)
    surplus = row.squares - row.bad * row.bad / row.n - spread * free
    correlation = surplus / between if between > 0 else LEAST_CORRELATION
    correlation = min(MOST_CORRELATION, max(LEAST_CORRELATION, correlation))
    return rate, 1.0 / correlation - 1


def host_posteriors(
    outcomes: DataFrame,
    suffix_rules: Sequence[str] = SUFFIX_RULES,
    others: DataFrame | None = None,
) -> DataFrame:
    """host, n, bad, mean, bound for every host with an outcome, and for every host in ``others``.

    ``outcomes``: host, bad (boolean; rows without it do not count). ``others``: host, repeated
    or not; without an outcome it has n = bad = 0, and its prior is the mean of its domain, else
    of its suffix, else of all pages. ``mean`` is the posterior rate of bad pages, ``bound``
    DEVIATIONS of its standard deviations lower. Counts are summed before any shuffle, and upper
    levels are made from the counts of the hosts; nine numbers reach the driver.
    """
    domain, suffix = host_levels(F.col("host"), suffix_rules)
    hosts = (
        outcomes.where(F.col("bad").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
        .withColumns({"domain": domain, "suffix": suffix})
    )
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    rate, for_suffix = _strength(suffixes)
    _, for_domain = _strength(domains)
    _, for_host = _strength(hosts)

    def shrunk(prior: Column, weight: float) -> Column:
        return (prior * weight + F.col("bad")) / (F.col("n") + weight)

    above = suffixes.select("suffix", shrunk(F.lit(rate), for_suffix).alias("_suffix"))
    domains = domains.join(above, "suffix").select(
        "suffix", "domain", shrunk(F.col("_suffix"), for_domain).alias("_domain")
    )
    known = hosts.join(domains, ["suffix", "domain"])
    known = known.select("host", "n", "bad", F.col("_domain").alias("_prior"))
    if others is not None:
        nothing = F.lit(0).cast("long")
        new = others.select("host").distinct().join(hosts.select("host"), "host", "left_anti")
        new = new.withColumns({"domain": domain, "suffix": suffix})
        new = new.join(domains, ["suffix", "domain"], "left").join(above, "suffix", "left")
        prior = F.coalesce("_domain", "_suffix", F.lit(rate))
        known = known.unionByName(
            new.select("host", nothing.alias("n"), nothing.alias("bad"), prior.alias("_prior"))
        )
    mean = shrunk(F.col("_prior"), for_host)
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + for_host + 1))
    return known.select("host", "n", "bad", mean.alias("mean")).withColumn(
        "bound", F.col("mean") - DEVIATIONS * deviation
    )


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    rules: Sequence[UrlRule] = RULES,
    block_above: float = BLOCK_ABOVE,
    suffix_rules: Sequence[str] = SUFFIX_RULES,
) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_rate, bad_bound of every page.

    ``outcomes``: page_id and bad of labelled pages; pages of the same id share them, and a page
    with several outcomes counts with each. The verdict is that of the longest fitting rule;
    without one, a host is blocked if its bound is above ``block_above``, and allowed if it is
    not. A host of which no page was labelled is judged by its prior. A null url has the empty
    host. Null ids have no outcome. One row per page, repeated ids included. ``suffix_rules`` as
    ``read_suffix_rules`` gives them tell under which suffix a domain is registered.

    A host with most of the pages is counted before the shuffle; where the posterior comes back
    to the pages, Spark's adaptive join splits it.
    """
    seen = pages.select(
        F.col(page_id).alias("page_id"),
        url_host(F.col(url)).alias("host"),
        url_path(F.col(url)).alias("path"),
    )
    labelled = seen.select("page_id", "host").join(
        outcomes.select(F.col(outcomes.columns[0]).alias("page_id"), F.col(outcomes.columns[1]).alias("bad")),
        "page_id",
    )
    posteriors = host_posteriors(labelled, suffix_rules, seen).select("host", "mean", "bound")
    rule, ruled = fitting_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("bound") > block_above, "block").otherwise("allow")
    return seen.join(posteriors, "host", "left").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(ruled, learned).alias("verdict"),
        F.col("mean").alias("bad_rate"),
        F.col("bound").alias("bad_bound"),
    )
