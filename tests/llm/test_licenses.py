"""License scans: patience alignment against plain versions."""

from __future__ import annotations

import random
from itertools import combinations

from pyspark.sql import functions as F

from rosterlake.llm import license_scan as scan
from rosterlake.llm import queries


def longest_increasing(values):
    for size in range(len(values), 0, -1):
        for chosen in combinations(values, size):
            if all(a < b for a, b in zip(chosen, chosen[1:])):
                return size
    return 0


def test_longest_increasing_subsequence():
    random.seed(1)
    for _ in range(200):
        values = random.sample(range(30), random.randrange(9))
        chain = scan.increasing(values)
        picked = [values[k] for k in chain]
        assert chain == sorted(chain) and all(a < b for a, b in zip(picked, picked[1:]))
        assert len(chain) == longest_increasing(values)


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_alignment_is_a_common_subsequence():
    random.seed(2)
    for _ in range(300):
        template = [random.choice("abcdefghij") + str(k % 7) for k in range(random.randrange(1, 30))]
        text = [w for w in template if random.random() < 0.9]
        for _ in range(random.randrange(8)):
            text.insert(random.randrange(len(text) + 1), random.choice(template + ["zz"]))
        aligned = scan.align(text, template)
        assert all(text[i] == template[j] for i, j in aligned)
        assert all(a < c and b < d for (a, b), (c, d) in zip(aligned, aligned[1:]))
        assert len(aligned) <= longest_common(text, template)


def test_a_whole_template_is_found_anywhere():
    templates = scan.Templates(scan.NOTICES, scan.LEAST_COVERAGE)
    random.seed(3)
    noise = [f"n{k}" for k in range(50)] + ["the", "license", "of", "software"]
    for name, text in scan.NOTICES.items():
        before, after = random.choices(noise, k=40), random.choices(noise, k=300)
        found = templates.found_in(" ".join([*before, text, *after]))
        best = {f["license"]: f for f in found}
        assert best[name]["coverage"] == 1.0, name
        words = scan.words_of(text)
        twice = templates.found_in(f"{text} and once more {text}")
        assert name in {f["license"] for f in twice if f["coverage"] == 1.0}, name
        assert best[name]["end"] - best[name]["begin"] >= len(words)


def test_changed_templates():
    text = scan.NOTICES["MIT-permission"]
    words = text.split()
    templates = scan.Templates({"MIT": text}, 0.8)
    few = " ".join(w for k, w in enumerate(words) if k % 10)
    assert templates.found_in(few)[0]["coverage"] >= 0.85
    assert templates.found_in(" ".join(words[: len(words) // 2])) == []
    assert templates.found_in(" ".join(reversed(words))) == []


def test_altered_notices_in_long_texts():
    """A dropped or changed word must not lose a notice, wherever that word stands besides."""
    random.seed(4)
    noise = [f"n{k}" for k in range(500)]
    for name in ("MIT", "MIT-permission", "Apache-2.0-header", "GPL-3.0-header"):
        text = scan.NOTICES[name]
        templates = scan.Templates({name: text}, 0.8)
        words = scan.words_of(text)
        for gone in {0, 1, len(words) // 2, *random.sample(range(len(words)), min(5, len(words)))}:
            if words[gone].isdigit() or words[gone] in ("apache", "mit"):
                continue
            altered = words[:gone] + words[gone + 1 :]
            for copies in (1, 2, 6):
                for far in ([], [words[gone]]):
                    between = random.choices(noise, k=30) if copies < 6 else []
                    around = random.choices(noise, k=900)
                    text = [*far, *around, *((altered + between) * copies), *around]
                    found = templates.found_in(" ".join(text))
                    assert found and found[0]["coverage"] >= 0.8, (name, words[gone], copies)
                    if not far:
                        assert found[0]["end"] - found[0]["begin"] < 2 * len(words) + 16
    far = "released " + "filler " * 500
    twice = far + "Distributed under the MIT License. " + "other " * 500 + "Distributed under the MIT License."
    best = scan.Templates({"MIT": scan.NOTICES["MIT"]}, 0.8).found_in(twice)[0]
    assert best == {"license": "MIT", "coverage": 0.8, "begin": 502, "end": 506}


def test_names_are_told_apart():
    templates = scan.Templates(scan.known_texts(), scan.LEAST_COVERAGE)

    def best(text):
        return (templates.found_in(text) or [{"license": None}])[0]["license"]

    header = scan.NOTICES["GPL-3.0-header"]
    lines = {
        "Licensed under CC BY-ND 4.0": "CC-BY-ND-4.0",
        "Licensed under CC BY-NC-SA 4.0": "CC-BY-NC-SA-4.0",
        "Licensed under CC BY 3.0": "CC-BY-3.0",
        "Released under the ISC License": "ISC",
        "Released under the Example License": None,
        "Licensed under the MIT License": "MIT",
        "This work is licensed under the GNU General Public License, version 2": "GPL-2.0",
        "This work is licensed under the GNU General Public License v3": "GPL-3.0",
        "This work is licensed under the GNU General Public License": None,
        header.replace("version 3", "version 2"): "GPL-2.0-header",
        header.replace("GNU", "GNU Lesser"): "LGPL-3.0-header",
        header.replace("GNU", "GNU Affero"): "AGPL-3.0-header",
        header.replace("hope that", "hope"): "GPL-3.0-header",
        scan.NOTICES["BSD-3-Clause-conditions"]: "BSD-3-Clause-conditions",
    }
    for text, name in lines.items():
        around = "Some words before it. " + text + ". Some words behind it."
        assert best(text) == best(around) == name, text
        others = {f["license"].split("-header")[0] for f in templates.found_in(around)}
        if name is not None:
            assert others == {name.split("-header")[0]}, text


def test_full_texts():
    texts = scan.known_texts()
    templates = scan.Templates(texts, scan.LEAST_COVERAGE)
    full = [name for name in texts if name.endswith("-full")]
    assert len(full) == 13
    for name in full:
        words = texts[name].split()
        for text in (words, [w for k, w in enumerate(words) if k % 50 or scan.words_of(w) != [w]]):
            found = {f["license"] for f in templates.found_in(" ".join(text)) if f["license"] in full}
            assert found == {name}


def test_all_licenses_of_a_text_are_listed(spark, monkeypatch):
    text = "Released under the MIT License. Docs: Licensed under CC BY-SA 4.0."
    frame = spark.createDataFrame([(1, text), (2, "none"), (3, None)], "doc_id long, text string")
    monkeypatch.setattr(queries, "_table", lambda *_: frame)
    rows = {r.doc_id: r for r in queries.op6_license_alignment(spark, "").collect()}
    assert rows[1].n_licenses == 2
    assert set(rows[1].licenses.split(",")) == {"MIT:0:5", "CC-BY-SA-4.0:6:13"}
    assert (rows[2].licenses, rows[3].licenses, rows[3].license) == ("", "", None)


def test_columns(spark):
    rows = [None, "", "no license", "x Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0", "the " * 50_000]
    frame = spark.createDataFrame([(t,) for t in rows], "text string").withColumn("license", F.lit(1))
    found = [r.f for r in frame.select(scan.scan_licenses()("text").alias("f")).collect()]
    assert [len(f) > 0 for f in found] == [False, False, False, True, True, False]
    assert (found[3][0].license, found[3][0].begin, found[3][0].end) == ("CC-BY-NC-4.0", 1, 8)
    assert found[4][0].license == "CC-BY-4.0"


def test_query(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op6_license_alignment(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        has = any(n.lower() in (texts[r.doc_id] or "").lower() for n in ("apache license", "gnu general public", "mit license", "under cc by"))
        assert (r.license is not None) == has and (r.n_licenses > 0) == has
