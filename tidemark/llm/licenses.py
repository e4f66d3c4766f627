"""Licence notices in texts, by patience alignment with templates.

Words that occur once in both the text and the template are anchors; the longest
rising run of anchors is kept, grown over equal neighbours, and the gaps between are
aligned the same way. Coverage is the share of the template's words that are matched.

A text that lacks too many of a template's words cannot reach the coverage and is not
aligned. Else the stretches of the text that hold enough of the words are aligned one
by one, so a notice that repeats is found each time.

Defined cases: null, empty and wordless texts have no notices; where notices overlap,
the one that matches more words stays, the first name at a tie; repeated rows are
scanned each; a text of any length is scanned to its end; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import arrow_schema, batches, with_workers

COVERAGE = 0.8
#: A stretch may hold so many words for each word of the template.
STRETCH = 1.3

# Short notices and texts of common licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain "
        "the above copyright notice, this list of conditions and the following disclaimer. 2. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution."),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version. This program is distributed in the hope "
        "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
        "more details."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

WORD = re.compile(r"[^\W_]+")
COLUMNS = ("doc_id bigint, license string, coverage double, first_word bigint, last_word bigint, "
           "matched bigint")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Rising pairs of places at which a and b hold the same word."""
    matched: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        i, i_end, j, j_end = gaps.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            matched.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            matched.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        at = {w: k for k, w in enumerate(a[i:i_end], i) if in_a[w] == 1 and in_b.get(w) == 1}
        anchors = _longest_rise([(at[w], k) for k, w in enumerate(b[j:j_end], j) if w in at])
        if not anchors:
            continue
        grown: list[tuple[int, int]] = []
        for n, (x, y) in enumerate(anchors):
            low = grown[-1] if grown else (i - 1, j - 1)
            high = anchors[n + 1] if n + 1 < len(anchors) else (i_end, j_end)
            back = 0
            while x - back - 1 > low[0] and y - back - 1 > low[1] and a[x - back - 1] == b[y - back - 1]:
                back += 1
            grown.extend((x - k, y - k) for k in range(back, -1, -1))
            while x + 1 < high[0] and y + 1 < high[1] and a[x + 1] == b[y + 1]:
                x, y = x + 1, y + 1
                grown.append((x, y))
        matched.extend(grown)
        edges = [(i - 1, j - 1), *grown, (i_end, j_end)]
        gaps.extend((p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:])
                    if q - p > 1 and s - r > 1)
    return sorted(matched)


def _longest_rise(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs that rises in both places; the second rises already."""
    ends: list[int] = []
    tails: list[int] = []
    back: list[int | None] = []
    for k, (x, _) in enumerate(pairs):
        at = bisect.bisect_left(ends, x)
        back.append(tails[at - 1] if at else None)
        ends[at:at + 1], tails[at:at + 1] = [x], [k]
    run, k = [], tails[-1] if tails else None
    while k is not None:
        run.append(pairs[k])
        k = back[k]
    return run[::-1]


class Template:
    def __init__(self, name: str, text: str, coverage: float):
        self.name, self.words = name, words_of(text)
        self.counts = Counter(self.words)
        self.least = int(np.ceil(coverage * len(self.words) - 1e-9))
        self.stretch = int(np.ceil(STRETCH * len(self.words))) + 2

    def possible(self, present: set[str]) -> bool:
        return sum(n for w, n in self.counts.items() if w in present) >= self.least

    def notices(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(first place, last place, words matched) of notices that reach the coverage."""
        hits = np.fromiter((w in self.counts for w in words), bool, len(words))
        spots, found, begin = np.flatnonzero(hits), [], 0
        # Stretches that begin at a template word and hold enough of them.
        last = np.searchsorted(spots, spots + self.stretch)
        good = np.flatnonzero(last - np.arange(len(spots)) >= self.least)
        for k in good:
            first = int(spots[k])
            if first < begin:
                continue
            until = first + self.stretch
            part = words[first:until]
            if sum((Counter(part) & self.counts).values()) < self.least:
                continue
            pairs = patience(part, self.words)
            while pairs and pairs[0][0]:  # again from where the notice begins, which may reach its end
                first += pairs[0][0]
                again = patience(words[first:first + self.stretch], self.words)
                if len(again) <= len(pairs):
                    pairs = [(x - pairs[0][0], y) for x, y in pairs]
                    break
                pairs = again
            if len(pairs) >= self.least:
                found.append((first + pairs[0][0], first + pairs[-1][0], len(pairs)))
                begin = found[-1][1] + 1
        return found


def scan(text: str | None, templates: list[Template]) -> list[tuple[str, float, int, int, int]]:
    """(licence, coverage, first word, last word, words matched), not overlapping, in order."""
    words = words_of(text)
    present, found = set(words), []
    for template in templates:
        if template.possible(present):
            for first, last, n in template.notices(words):
                found.append((n, n / len(template.words), template.name, first, last))
    found.sort(key=lambda f: (-f[0], -f[1], f[2], f[3]))
    kept: list[tuple] = []
    for n, coverage, name, first, last in found:
        if all(last < k[2] or first > k[3] for k in kept):
            kept.append((name, coverage, first, last, n))
    return sorted(kept, key=lambda k: k[2])


def _scan_all(texts: dict[str, str], coverage: float):
    def run(rows):
        templates = [Template(name, text, coverage) for name, text in sorted(texts.items())]

        def out():
            for batch in rows:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for notice in scan(text.as_py(), templates):
                        yield (doc_id, *notice)

        yield from batches(out(), arrow_schema(COLUMNS))

    return run


def find(spark: SparkSession, docs: DataFrame, templates: dict[str, str] | None = None,
         coverage: float = COVERAGE) -> DataFrame:
    """One row for each notice of each document."""
    with_workers(spark)
    return docs.select("doc_id", "text").mapInArrow(
        _scan_all(templates or TEMPLATES, coverage), COLUMNS)
