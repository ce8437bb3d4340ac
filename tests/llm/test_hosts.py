"""Hosts, rules and posteriors against plain versions."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from rosterlake.llm import host_reputation as hr
from rosterlake.llm import oracle, queries
import parity

URLS = {
    None: ("", ""),
    "": ("", ""),
    "no scheme/path": ("", ""),
    "http://A.Example.ORG/En/1?x#y": ("a.example.org", "/En/1"),
    "http://example.org": ("example.org", ""),
    "http://example.org?q=/es/": ("example.org", ""),
    "https://x.org/a://b/c": ("x.org", "/a://b/c"),
    "://h/p#?": ("h", "/p"),
    "ftp://ÀB.com:80/\n/x?": ("Àb.com:80", "/\n/x"),
    "http:///only/path": ("", "/only/path"),
}


def test_host_and_path(spark):
    frame = spark.createDataFrame([(u,) for u in URLS], "url string")
    rows = frame.select("url", hr.url_host(F.col("url")).alias("h"), hr.url_path(F.col("url")).alias("p"))
    assert {r.url: (r.h, r.p) for r in rows.collect()} == URLS


def plain_rule(host, path, rules):
    best = None
    for rule in rules:
        on_host = host == rule.host or host.endswith("." + rule.host)
        if on_host and path.startswith(rule.path) and (best is None or len(rule.pattern) > len(best.pattern)):
            best = rule
    return (best.pattern, best.verdict) if best else (None, None)


def test_rules(spark):
    hosts = ["org", "example.org", "a.example.org", "xexample.org", "b.com", "com", "org.net", ""]
    paths = ["", "/", "/es", "/es/", "/en/1", "/en/12", "/en/2", "/fr/x", "/de/", "/x/de/"]
    rows = [(h, p) for h in hosts for p in paths]
    frame = spark.createDataFrame(rows, "host string, path string")
    rule, verdict = hr.fitting_rule(F.col("host"), F.col("path"), hr.RULES)
    for r in frame.select("host", "path", rule.alias("rule"), verdict.alias("verdict")).collect():
        assert (r.rule, r.verdict) == plain_rule(r.host, r.path, hr.RULES)
    none, _ = hr.fitting_rule(F.col("host"), F.col("path"), [])
    assert frame.select(none.alias("r")).distinct().collect()[0].r is None


def test_levels(spark):
    expected = {
        "a.b.example.com": ("example.com", "com"),
        "shop.example.co.uk:8080": ("example.co.uk", "co.uk"),
        "co.uk": ("co.uk", "co.uk"),
        "localhost": ("localhost", "localhost"),
        "10.1.2.3": ("10.1.2.3", "10.1.2.3"),
        "": ("", ""),
    }
    domain, suffix = hr.host_levels(F.col("h"))
    frame = spark.createDataFrame([(h,) for h in expected], "h string")
    assert {r.h: (r.d, r.s) for r in frame.select("h", domain.alias("d"), suffix.alias("s")).collect()} == expected


def strength(groups):
    total, bad = sum(n for n, _ in groups), sum(b for _, b in groups)
    rate = bad / total
    spread, free = rate * (1 - rate), len(groups) - 1
    between = spread * (total - sum(n * n for n, _ in groups) / total - free)
    surplus = sum(b * b / n for n, b in groups) - bad * bad / total - spread * free
    correlation = surplus / between if between > 0 else hr.LEAST_CORRELATION
    return rate, 1 / min(hr.MOST_CORRELATION, max(hr.LEAST_CORRELATION, correlation)) - 1


def summed(groups, key):
    found = {}
    for name, (n, b) in groups.items():
        m, c = found.get(key(name), (0, 0))
        found[key(name)] = (m + n, c + b)
    return found


def test_posteriors(spark):
    random.seed(1)
    outcomes = []
    for domain, rate in (("good.com", 0.02), ("bad.com", 0.95), ("mixed.net", 0.5), ("rare.net", 1.0)):
        for sub in range(1 if domain == "rare.net" else 5):
            for _ in range(1 if domain == "rare.net" else random.choice([2, 40, 200])):
                outcomes.append((f"h{sub}.{domain}", random.random() < rate))
    outcomes += [("null.com", None)]
    frame = spark.createDataFrame(outcomes, "host string, bad boolean").repartition(3)
    hosts = {}
    for host, bad in outcomes:
        if bad is not None:
            n, b = hosts.get(host, (0, 0))
            hosts[host] = (n + 1, b + bad)
    domains = summed(hosts, lambda h: h.partition(".")[2])
    suffixes = summed(domains, lambda d: d.rpartition(".")[2])
    rate, w_suffix = strength(list(suffixes.values()))
    (_, w_domain), (_, w_host) = strength(list(domains.values())), strength(list(hosts.values()))
    found = {r.host: r for r in hr.host_posteriors(frame).collect()}
    assert set(found) == set(hosts)
    for host, (n, b) in hosts.items():
        domain = host.partition(".")[2]
        sn, sb = suffixes[domain.rpartition(".")[2]]
        dn, db = domains[domain]
        above = (rate * w_suffix + sb) / (sn + w_suffix)
        middle = (above * w_domain + db) / (dn + w_domain)
        mean = (middle * w_host + b) / (n + w_host)
        assert (found[host].n, found[host].bad) == (n, b) and abs(found[host].mean - mean) < 1e-9
        bound = mean - hr.DEVIATIONS * math.sqrt(mean * (1 - mean) / (n + w_host + 1))
        assert abs(found[host].bound - bound) < 1e-9
    assert found["h0.rare.net"].bound < 0.5, "one bad page does not condemn a host"
    assert max(found[f"h{k}.bad.com"].bound for k in range(5)) > 0.5


def test_verdicts(spark):
    pages = [(k, f"http://{'spam' if k % 2 else 'fine'}.example.net/p{k}", 0) for k in range(400)]
    pages += [(None, "http://spam.example.net/", 0), (900, None, 0), (901, "http://new.example.net/de/", 0), (0, "http://a.com/de/x", 0)]
    frame = spark.createDataFrame(pages, "page_id long, url string, host int")
    outcomes = spark.createDataFrame([(k, k % 2 == 1) for k in range(300)] + [(300, None), (None, True)], "id long, bad boolean")
    judged = hr.judge_urls(frame, outcomes)
    rows = judged.collect()
    assert len(rows) == len(pages)
    for r in rows:
        if r.rule is None:
            assert r.verdict == ("block" if r.host == "spam.example.net" else "allow")
    assert [r.verdict for r in rows if r.rule == "com/de/"] == ["block"]
    assert hr.judge_urls(frame, outcomes.limit(0)).where("verdict = 'block'").count() == 1
    assert hr.judge_urls(frame.limit(0), outcomes).count() == 0


def test_hosts_without_outcomes(spark):
    """An unlabelled host has the mean of its domain, else of its suffix, else of all pages."""
    labels = [("com", "bad", 950, 1000), ("com", "good", 10, 1000), ("net", "x", 5, 400), ("biz", "y", 600, 600)]
    pages, outcomes = [], []
    for suffix, domain, bad, n in labels:
        for k in range(n):
            outcomes.append((len(pages), k < bad))
            pages.append((len(pages), f"http://h{k % 9}.{domain}.{suffix}/p"))
    new = ["new1234.bad.com", "new.good.com", "other.com", "other.biz", "a.unseen", "new1234.bad.com", ""]
    pages += [(len(pages) + k, f"http://{h}/p") for k, h in enumerate(new)]
    frame = spark.createDataFrame(pages, "page_id long, url string").repartition(3)
    judged = hr.judge_urls(frame, spark.createDataFrame(outcomes, "id long, bad boolean"), rules=[])
    rows = judged.collect()
    assert len(rows) == len(pages)
    hosts, groups = {r.host: r for r in rows}, {}
    for (_, url), (_, bad) in zip(pages, outcomes):
        n, b = groups.get(url.split("/")[2], (0, 0))
        groups[url.split("/")[2]] = (n + 1, b + bad)
    domains = summed(groups, lambda h: h.partition(".")[2])
    suffixes = summed(domains, lambda d: d.rpartition(".")[2])
    (rate, w_suffix), (_, w_domain) = strength(list(suffixes.values())), strength(list(domains.values()))
    _, w_host = strength(list(groups.values()))
    suffix_mean = {s: (rate * w_suffix + b) / (n + w_suffix) for s, (n, b) in suffixes.items()}
    (n, b) = domains["bad.com"]
    expected = {
        "new1234.bad.com": (suffix_mean["com"] * w_domain + b) / (n + w_domain),
        "other.com": suffix_mean["com"],
        "other.biz": suffix_mean["biz"],
        "a.unseen": rate,
        "": rate,
    }
    for host, mean in expected.items():
        bound = mean - hr.DEVIATIONS * math.sqrt(mean * (1 - mean) / (w_host + 1))
        assert abs(hosts[host].bad_rate - mean) < 1e-9 and abs(hosts[host].bad_bound - bound) < 1e-9
        assert hosts[host].verdict == ("block" if bound > 0.5 else "allow")
    assert hosts["new1234.bad.com"].verdict == "block" and hosts["new.good.com"].verdict == "allow"


def test_suffix_rules(spark, tmp_path):
    """Longest rule, any label, exceptions; rules come from a file with comments."""
    path = tmp_path / "suffixes.dat"
    path.write_text("// a comment\n\ncom\nCo.UK\nin\nco.in  and more\nck\n*.ck\n!www.ck\nhost.example.io\n")
    rules = hr.read_suffix_rules(spark, str(path))
    assert rules == ["!www.ck", "*.ck", "ck", "co.in", "co.uk", "com", "host.example.io", "in"]
    expected = {
        "x.foo.co.in": ("foo.co.in", "co.in"),
        "x.foo.in": ("foo.in", "in"),
        "a.b.co.uk:80": ("b.co.uk", "co.uk"),
        "a.b.c.ck": ("b.c.ck", "c.ck"),
        "c.ck": ("c.ck", "c.ck"),
        "ck": ("ck", "ck"),
        "a.www.ck": ("www.ck", "ck"),
        "www.ck": ("www.ck", "ck"),
        "one.host.example.io": ("one.host.example.io", "host.example.io"),
        "two.example.io": ("example.io", "io"),
        "a.notco.in": ("notco.in", "in"),
        "a.unknown.zz": ("unknown.zz", "zz"),
        "10.0.0.1": ("10.0.0.1", "10.0.0.1"),
        "single": ("single", "single"),
        "": ("", ""),
    }
    frame = spark.createDataFrame([(h,) for h in expected], "host string")
    domain, suffix = hr.host_levels(F.col("host"), rules)
    found = {r.host: (r.d, r.s) for r in frame.select("host", domain.alias("d"), suffix.alias("s")).collect()}
    assert found == expected


def test_query_against_sql(spark, folder):
    con = parity.connect(folder)
    parity.assert_same(queries.op4_host_reputation(spark, folder), con, oracle.ORACLES["op4_host_reputation"])
    con.close()
