"""License scans by patience alignment.

A template's words are aligned with a text's: words that occur once in both are
anchors; the longest run of anchors that ascends in both (a longest increasing
subsequence) is kept, matching words next to an anchor join it, and each gap
between anchors is aligned in the same way. A gap without anchors, no longer
than a template on one side, is aligned by a longest common subsequence.
Coverage is the share of the template's words that are aligned, and must be
reached the other way too: by the share of the words from the first aligned one
to the last. Stray matches at either end are let go for that.

Licences of one family differ in a word or a number. Those that tell them apart
(``TELLING``, and numbers) may not be missed: a template's must all be aligned,
and the place may hold none that the template has not.

A long text is looked at in overlapping windows of ``SPAN`` times the
template's length, each window that holds enough of the template's words to
reach the wanted coverage; no other window can reach it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import arrow_table, map_batches, slices

COVERAGE = 0.8
SPAN = 2
_WORD = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")

# Words of which a notice that has one more or less is another licence's.
TELLING = frozenset(
    "affero apache artistic attribution boost bsd cc cc0 commons creative eclipse gnu isc lesser library mit mozilla mpl nc nd noncommercial "
    "noderivatives noderivs sa sharealike unlicense zlib".split()
)

# Notices of common licences, in their own words.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software"
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation"
    ),
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}


# Siblings of these, by their parts: every kind of one family has its own templates.
_CC = {"BY": "", "BY-SA": "-ShareAlike", "BY-NC": "-NonCommercial", "BY-ND": "-NoDerivatives", "BY-NC-SA": "-NonCommercial-ShareAlike", "BY-NC-ND": "-NonCommercial-NoDerivatives"}
for _kind, _named in _CC.items():
    TEMPLATES.setdefault(f"CC-{_kind}-4.0", f"Licensed under CC {_kind} 4.0.")
    TEMPLATES[f"CC-{_kind}-4.0-short"] = f"Licensed under CC {_kind} 4.0."
    TEMPLATES[f"CC-{_kind}-4.0-long"] = f"This work is licensed under a Creative Commons Attribution{_named} 4.0 International License."
for _short, _family, _versions in (("GPL", "", ("2.0", "3.0")), ("LGPL", "Lesser ", ("2.1", "3.0")), ("AGPL", "Affero ", ("3.0",))):
    TEMPLATES[f"{_short}-header"] = (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {_family}General Public License as published "
        "by the Free Software Foundation"
    )
    for _v in _versions:
        TEMPLATES[f"{_short}-{_v}"] = f"This work is licensed under the GNU {_family}General Public License, version {_v.removesuffix('.0')}."
for _name in ("BSD", "ISC"):
    TEMPLATES[f"{_name}-line"] = f"Released under the {_name} License."
TEMPLATES["Apache-1.1"] = "Licensed under the Apache License, Version 1.1."

# Notices in full.
_AS_IS = "the software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose"
TEMPLATES["MIT-full"] = (
    f"{TEMPLATES['MIT-grant']}, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    f"{_AS_IS} and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an "
    "action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software."
)
TEMPLATES["BSD-2-Clause"] = (
    f"{TEMPLATES['BSD']}: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution."
)
TEMPLATES["BSD-3-Clause"] = (
    f"{TEMPLATES['BSD-2-Clause']} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
TEMPLATES["ISC-full"] = (
    f"{TEMPLATES['ISC']}, provided that the above copyright notice and this permission notice appear in all copies."
)
TEMPLATES["Apache-2.0-full-header"] = (
    f"{TEMPLATES['Apache-2.0-header']} http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
    "under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
    "specific language governing permissions and limitations under the License."
)


def words_of(text: str) -> list[str]:
    """Lower-case words and numbers; 2.0 and 2 are one number."""
    return [w[:-2] if w.endswith(".0") and w[:-2].isdigit() else w for w in _WORD.findall(text.lower())]


def _telling(word: str) -> bool:
    return word in TELLING or word.replace(".", "").isdigit()


def trim(pairs: list[tuple[int, int]], coverage: float) -> list[tuple[int, int]]:
    """``pairs`` without stray ones at the ends, so that of the words from the
    first to the last a share of ``coverage`` is aligned."""
    begin, end = 0, len(pairs)
    while end - begin > 1 and end - begin < coverage * (pairs[end - 1][1] - pairs[begin][1] + 1):
        if pairs[begin + 1][1] - pairs[begin][1] >= pairs[end - 1][1] - pairs[end - 2][1]:
            begin += 1
        else:
            end -= 1
    return pairs[begin:end]


def _ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest subsequence, of pairs ascending in the first place, that also
    ascends in the second: patience sorting with links to the pile before."""
    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for at, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        before.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            piles.append(at)
        else:
            tops[pile], piles[pile] = j, at
    out, at = [], piles[-1] if piles else -1
    while at >= 0:
        out.append(pairs[at])
        at = before[at]
    return out[::-1]


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            table[i][j] = table[i + 1][j + 1] + 1 if a[i] == b[j] else max(table[i + 1][j], table[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j] and table[i][j] == table[i + 1][j + 1] + 1:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif table[i + 1][j] >= table[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(template: list[str], text: list[str]) -> list[tuple[int, int]]:
    """Pairs of places (template, text) of aligned words, ascending in both."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(template), 0, len(text))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and template[a] == text[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        mine, theirs = Counter(template[a:b]), Counter(text[c:d])
        place = {w: j for j, w in enumerate(text[c:d], c) if theirs[w] == 1 and mine[w] == 1}
        anchors = _ascending([(i, place[w]) for i, w in enumerate(template[a:b], a) if w in place])
        if not anchors:
            out += [(a + i, c + j) for i, j in _common(template[a:b], text[c:d])]
            continue
        out += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges[:-1], edges[1:], strict=True) if k > i + 1 and m > j + 1]
    return sorted(out)


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float):
        self.coverage = coverage
        self.templates = [(name, words) for name, text in sorted(templates.items()) if (words := words_of(text))]
        self.ids = {w: k for k, w in enumerate(sorted({w for _, words in self.templates for w in words}))}
        self.needs = []  # per template: how often it has each word, how many words must be there, and which may not be missed
        for _, words in self.templates:
            need = np.bincount([self.ids[w] for w in words], minlength=len(self.ids))
            must = sorted({self.ids[w] for w in words if _telling(w)})
            self.needs.append((need, int(np.ceil(coverage * len(words) - 1e-9)), must))

    def scan(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """(template, words aligned, words in the template, start, stop) of the
        best window of every template that reaches the coverage; start and
        stop count the text's words. Of windows that overlap, of whichever
        templates, only the one with the most aligned words counts."""
        words = words_of(text)
        codes = np.array([self.ids.get(w, -1) for w in words], dtype=np.int64)
        at = np.flatnonzero(codes >= 0)
        if not len(at):
            return []
        have = np.bincount(codes[at], minlength=len(self.ids))
        out: set[tuple[int, float, str, int, int, int]] = set()
        for (name, template), (need, least, must) in zip(self.templates, self.needs, strict=True):
            if (must and not have[must].all()) or np.minimum(have, need).sum() < least:
                continue
            telling = [i for i, w in enumerate(template) if _telling(w)]
            names = TELLING.intersection(template)
            mine = at[need[codes[at]] > 0]
            size, step = SPAN * len(template), max(1, len(template) // 2)
            for begin in sorted({max(0, int(p) // step * step - k * step) for p in mine for k in range(size // step + 1)}):
                inside = mine[np.searchsorted(mine, begin) : np.searchsorted(mine, begin + size)]
                if len(inside) < least or np.minimum(np.bincount(codes[inside], minlength=len(need)), need).sum() < least:
                    continue
                pairs = trim(align(template, words[begin : begin + size]), self.coverage)
                if len(pairs) < least or not {i for i, _ in pairs}.issuperset(telling):
                    continue
                place = words[begin + pairs[0][1] : begin + pairs[-1][1] + 1]
                if TELLING.intersection(place) == names:
                    out.add((-len(pairs), -len(pairs) / len(template), name, begin + pairs[0][1], begin + pairs[-1][1] + 1, len(template)))
        kept: dict[str, tuple[str, int, int, int, int]] = {}
        starts: list[int] = []  # of the places taken, which do not overlap
        stops: list[int] = []
        for aligned, _, name, start, stop, size in sorted(out):
            k = bisect_left(starts, stop)
            if k and stops[k - 1] > start:
                continue
            starts.insert(k, start)
            stops.insert(k, stop)
            kept.setdefault(name, (name, -aligned, size, start, stop))
        return list(kept.values())


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, coverage, n_aligned, start_word, stop_word): one row per
    document row and template whose words are aligned to ``coverage`` or more
    in some window of the whole text, with all words that tell licences apart and
    none besides; of several windows the best, and of equally good ones the first. Where windows overlap in a text, only the one
    with the most aligned words counts, so a template that stands within a
    longer notice is reported if it also stands elsewhere.

    A null, empty or wordless text gives no rows, and neither does an empty
    table; repeated documents each give theirs; other columns are ignored.
    Templates without words are left out.
    """
    scanner = Scanner(TEMPLATES if templates is None else templates, coverage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                found = [(doc, *hit) for doc, t in zip(part.column("doc_id").to_pylist(), texts, strict=True) for hit in scanner.scan(t)]
                columns = {
                    "doc_id": [f[0] for f in found], "license": [f[1] for f in found], "coverage": [f[2] / f[3] for f in found],
                    "n_aligned": [f[2] for f in found], "start_word": [f[4] for f in found], "stop_word": [f[5] for f in found],
                }
                yield arrow_table(columns, {"doc_id": pa.int64(), "license": pa.string(), "coverage": pa.float64()} | dict.fromkeys(("n_aligned", "start_word", "stop_word"), pa.int64()))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, license string, coverage double, n_aligned long, start_word long, stop_word long")
