"""License texts in documents by patience alignment.

Words that occur once in the text and once in the template are anchors; the longest increasing
subsequence of their places keeps those in order, and the gaps between neighbouring anchors are
aligned in the same way, with words that are unique within the gap. What is aligned, as a share
of the template's words, is the coverage. Where words repeat, stretches of the text are aligned
one by one: those in which enough of the template's words stand, each from the place that most of
the template's rarer words point to.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from importlib import resources

import pyarrow as pa
from pyspark.sql.functions import arrow_udf

# A template is reported from this share of its words on.
LEAST_COVERAGE = 0.8

# Notices by which a work names its license.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License."
    ),
    "BSD-2-Clause-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details."
    ),
    "MIT": "Released under the MIT License",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software."
    ),
}

# Headers, lines and short licenses besides those above.
_GNU = (
    "This {thing} is free software{colon} you can redistribute it and/or modify it under the terms "
    "of the GNU {kind}General Public License as published by the Free Software Foundation, either "
    "version {version} of the License, or (at your option) any later version. This {thing} is "
    "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
    "{kind}General Public License for more details."
)
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
NOTICES |= {
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted."
    ),
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "AGPL-3.0-header": _GNU.format(thing="program", colon=":", kind="Affero ", version=3),
    "AGPL-3.0-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "BSD-2-Clause": "Released under the BSD 2-Clause License",
    "BSD-3-Clause": "Released under the BSD 3-Clause License",
    "BSD-3-Clause-conditions": (
        NOTICES["BSD-2-Clause-conditions"] + " Neither the name of the copyright holder nor the "
        "names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission."
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license (the "
        "\"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, "
        "and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following:"
    ),
    "CC0-1.0": "Released under CC0 1.0 Universal",
    "EPL-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-2.0-header": _GNU.format(thing="program", colon=";", kind="", version=2),
    "ISC": "Released under the ISC License",
    "ISC-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."
    ),
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "LGPL-2.1-header": _GNU.format(thing="library", colon=";", kind="Lesser ", version="2.1"),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "LGPL-3.0-header": _GNU.format(thing="program", colon=":", kind="Lesser ", version=3),
    "MIT-text": (
        NOTICES["MIT-permission"] + " " + _AS_IS
    ),
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0",
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
        "any means."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: The origin of this software must not be misrepresented; you must "
        "not claim that you wrote the original software."
    ),
}
for _kind in ("BY", "BY-NC", "BY-ND", "BY-SA", "BY-NC-ND", "BY-NC-SA"):
    for _version in ("2.0", "2.5", "3.0", "4.0"):
        NOTICES[f"CC-{_kind}-{_version}"] = f"Licensed under CC {_kind} {_version}"
    _words = [
        {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}[k]
        for k in _kind.split("-")
    ]
    NOTICES[f"CC-{_kind}-4.0-name"] = (
        f"This work is licensed under a Creative Commons {'-'.join(_words)} 4.0 International License"
    )

# Licenses that begin like a longer one are not reported where the longer one stands.
PART_OF = {"BSD-2-Clause-conditions": "BSD-3-Clause-conditions", "0BSD": "ISC-permission"}

# Words that tell licenses apart: of any template, and names, of short templates.
_MARKS = frozenset(
    "affero lesser nc nd sa noncommercial noderivatives noderivs sharealike cc0".split()
)
_NAMES = frozenset(
    "agpl apache artistic boost bsd eclipse epl gpl isc lgpl mit mozilla mpl wtfpl zlib".split()
)
SHORT = 40
# Words left out, and words put in, that are taken for one local change.
_LEFT_OUT, _PUT_IN = 3, 6
_NUMBER = re.compile(r"v?(\d{1,2})")

_WORD = re.compile(r"[a-z0-9]+")

RESULT = "array<struct<license: string, coverage: double, begin: int, end: int>>"
_TYPE = pa.list_(
    pa.struct(
        [
            ("license", pa.string()),
            ("coverage", pa.float64()),
            ("begin", pa.int32()),
            ("end", pa.int32()),
        ]
    )
)


def words_of(text: str) -> list[str]:
    """Runs of a-z and 0-9, in lower case."""
    return _WORD.findall(text.lower())


def increasing(places: Sequence[int]) -> list[int]:
    """Positions in ``places`` of a longest strictly increasing subsequence."""
    ends: list[int] = []  # the smallest last value of a subsequence of each length
    last: list[int] = []  # its position
    before = [-1] * len(places)
    for k, value in enumerate(places):
        length = bisect_left(ends, value)
        if length == len(ends):
            ends.append(value)
            last.append(k)
        else:
            ends[length], last[length] = value, k
        before[k] = last[length - 1] if length else -1
    chain: list[int] = []
    k = last[-1] if last else -1
    while k >= 0:
        chain.append(k)
        k = before[k]
    return chain[::-1]


def _once(words: Sequence[str], begin: int, end: int) -> dict[str, int]:
    """The place of each word that occurs once in words[begin:end]."""
    counts = Counter(words[begin:end])
    return {words[k]: k for k in range(begin, end) if counts[words[k]] == 1}


def align(text: Sequence[str], template: Sequence[str]) -> list[tuple[int, int]]:
    """Aligned places (in the text, in the template), increasing in both."""
    aligned: list[tuple[int, int]] = []
    open_gaps = [(0, len(text), 0, len(template))]
    while open_gaps:
        a, b, c, d = open_gaps.pop()
        # equal words at either end of a gap need no anchor, except at the ends of the text
        while c > 0 and a < b and c < d and text[a] == template[c] and (a, c) != (0, 0):
            aligned.append((a, c))
            a, c = a + 1, c + 1
        while d < len(template) and a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            aligned.append((b, d))
        if a >= b or c >= d:
            continue
        in_text, in_template = _once(text, a, b), _once(template, c, d)
        shared = [(in_text[w], k) for w, k in in_template.items() if w in in_text]
        anchors = [shared[k] for k in increasing([place for place, _ in shared])]
        if not anchors:
            continue
        aligned += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        for (i, j), (k, m) in zip(edges, edges[1:], strict=False):
            open_gaps.append((i + 1, k, j + 1, m))
    return sorted(aligned)


def known_texts() -> dict[str, str]:
    """All notices, and full texts by the names of their files."""
    found = dict(NOTICES)
    for file in resources.files("rosterlake.llm.licenses").iterdir():
        if file.name.endswith(".txt"):
            found[file.name.removesuffix(".txt") + "-full"] = file.read_text("utf-8")
    return found


def _marks(words: Sequence[str], begin: int, end: int, short: bool) -> set[str]:
    """The words in words[begin:end] that tell licenses apart: variants, versions, and in short
    texts all small numbers and names."""
    found = set()
    for k in range(max(0, begin), min(end, len(words))):
        word = words[k]
        if word in _MARKS or short and word in _NAMES:
            found.add(word)
        elif word == "library" and words[k + 1 : k + 2] == ["general"]:
            found.add(word)
        elif number := _NUMBER.fullmatch(word):
            before = k - 1
            while before > 0 and k - before < 3 and _NUMBER.fullmatch(words[before]):
                before -= 1
            if short or word[0] == "v" or before >= 0 and words[before] in ("version", "v"):
                found.add(number.group(1))
    return found


def names_agree(
    text: Sequence[str], template: Sequence[str], aligned: Sequence[tuple[int, int]]
) -> bool:
    """Whether no local change leaves out or puts in a word that tells licenses apart."""
    short = len(template) <= SHORT
    last = len(aligned)
    for n in range(last + 1):
        i, j = aligned[n - 1] if n else (-1, -1)
        k, m = aligned[n] if n < last else (len(text), len(template))
        if k - i == 1 and m - j == 1 or j + 1 == m and n in (0, last):
            continue
        expected = _marks(template, j + 1, m, short)
        if 0 < n < last:
            here = _marks(text, i + 1, k, short)
            if k - i - 1 <= _PUT_IN and here - expected:
                return False
        elif m - j - 1 > SHORT:
            continue
        else:  # what stands at the place of the template's first or last words
            size = m - j + 2
            here = _marks(text, k - size, k, short) if n == 0 else _marks(text, i + 1, i + size, short)
        other = expected - here
        if other and (m - j - 1 <= _LEFT_OUT or n in (0, last) and here - expected):
            return False
    return True


def _is_part(found: dict, whole: dict | None) -> bool:
    return whole is not None and whole["begin"] <= found["begin"] and found["end"] <= whole["end"]


class Templates:
    """License texts as words, with the words that can lead to each."""

    def __init__(self, texts: Mapping[str, str], least: float):
        self.least = least
        self.words = {name: words_of(text) for name, text in sorted(texts.items())}
        self.counts = {name: Counter(words) for name, words in self.words.items()}
        self.guides = {name: self._guides(name) for name in self.words}
        all_words = Counter(w for counts in self.counts.values() for w in counts)
        self.vocabulary = frozenset(all_words)

    def _guides(self, name: str) -> dict[str, list[int]]:
        """Places in the template of its least repeated words, so many that no text covers the
        template without one of them."""
        counts, places = self.counts[name], {}
        spare = (1 - self.least) * len(self.words[name])
        for word in sorted(counts, key=lambda w: (counts[w], w)):
            if spare < 0 and counts[word] > 1:
                break
            places[word] = [k for k, w in enumerate(self.words[name]) if w == word]
            spare -= counts[word]
        return places

    def found_in(self, text: str) -> list[dict]:
        """All templates that are covered, best first. ``begin`` and ``end`` count words."""
        words = words_of(text)
        here = Counter(w for w in words if w in self.vocabulary)
        if not here:
            return []
        found = []
        for name, template in self.words.items():
            if len(words) < self.least * len(template):
                continue
            counts = self.counts[name]
            # no alignment covers more words than text and template share
            shared = sum(min(n, here[w]) for w, n in counts.items())
            if shared < self.least * len(template):
                continue
            best = self._best(words, name)
            if best is not None:
                found.append({"license": name} | best)

        whole = {f["license"]: f for f in found}
        found = [f for f in found if not _is_part(f, whole.get(PART_OF.get(f["license"])))]

        def rank(f: dict) -> tuple:
            return -f["coverage"], -len(self.words[f["license"]]), f["begin"], f["license"]

        return sorted(found, key=rank)

    def _best(self, words: list[str], name: str) -> dict | None:
        """The best alignment: with the whole text, or, where words repeat, with stretches in
        which enough of the template stands."""
        template = self.words[name]
        best = self._covered(words, 0, len(words), template)
        if best is not None and best["coverage"] == 1.0:
            return best
        size, slack = len(template), len(template) // 2 + 8
        for start in self._starts(words, name, slack):
            for more in (0, slack):  # as it stands, and with changes around
                begin, end = max(0, start - more), min(len(words), start + size + more)
                other = self._covered(words, begin, end, template)
                if other is not None and (best is None or other["coverage"] > best["coverage"]):
                    best = other
            if best is not None and best["coverage"] == 1.0:
                return best
        return best

    def _starts(self, words: list[str], name: str, slack: int) -> list[int]:
        """Where the template may begin: of each quarter of its length, the place that most of
        its guides vote for, if enough of its words stand around. One of the guides stands in
        any text that covers the template."""
        size, guides = len(self.words[name]), self.guides[name]
        votes: dict[int, Counter] = {}
        quarter = max(1, size // 4)
        for place, word in enumerate(words):
            for k in guides.get(word, ()):
                votes.setdefault((place - k) // quarter, Counter())[place - k] += 1
        dense = self._dense(words, name, size + 2 * slack)
        chosen = (min(c, key=lambda start: (-c[start], start)) for c in votes.values())
        return sorted(s for s in chosen if dense[max(0, s - slack)])

    def _dense(self, words: list[str], name: str, width: int) -> list[bool]:
        """For each place, whether enough words of the template stand in the ``width`` words from
        it on, each as often as the template has it at most."""
        left = dict(self.counts[name])  # what the template has beyond the stretch
        need = self.least * len(self.words[name]) - 1e-9
        shared = 0
        dense = [False] * len(words)
        for place in range(-width, len(words)):
            if place + width < len(words):
                word = words[place + width]
                if word in left:
                    shared += left[word] > 0
                    left[word] -= 1
            if place >= 0:
                dense[place] = shared >= need
                word = words[place]
                if word in left:
                    left[word] += 1
                    shared -= left[word] > 0
        return dense

    def _covered(self, words: list[str], begin: int, end: int, template: list[str]) -> dict | None:
        aligned = align(words[begin:end], template)
        coverage = len(aligned) / len(template)
        if not aligned or coverage < self.least:
            return None
        if not names_agree(words, template, [(begin + i, j) for i, j in aligned]):
            return None
        return {
            "coverage": coverage,
            "begin": begin + aligned[0][0],
            "end": begin + aligned[-1][0] + 1,
        }


def scan_licenses(
    texts: Mapping[str, str] | None = None, least: float = LEAST_COVERAGE
) -> Callable:
    """A function from a text column to an array of (license, coverage, begin, end), the license
    covered best first; of equally covered ones the one with more words, then the earlier one.

    ``texts``: license texts by name, the same few for all documents; all known ones by default.
    A license is not named if a local change leaves out or puts in a word that tells licenses
    apart (``names_agree``). Null, empty and other texts
    without a license give an empty array. Texts are read whole; ``begin`` and ``end`` count
    their words (runs of letters a-z and digits).
    """

    texts = known_texts() if texts is None else texts

    @arrow_udf(RESULT)
    def run(column: pa.Array) -> pa.Array:
        templates = Templates(texts, least)
        return pa.array([templates.found_in(text.as_py() or "") for text in column], _TYPE)

    return run
