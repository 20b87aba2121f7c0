"""License scans.

Templates are read as word sequences. Their k-word fingerprints are winnowed
(of any ``window`` fingerprints in a row the smallest is kept; of templates with
fewer than ``window + k - 1`` fingerprints all are), and an
inverted index leads from a fingerprint to its places in the templates. Every
k-word sequence of a text is looked up, so a run of ``window + k - 1`` words
shared with a template always gives a candidate. Around each candidate's
diagonal a banded alignment matches the whole template with a stretch of the
text; reported are the share of the template's words that match and the
stretch's place. Every template that matches is
reported; of matches of different licenses that overlap by most of the shorter
one, those that another explains better are not ``best``.

The templates are a small bounded table (``MAX_TEMPLATE_WORDS`` words), so the
index travels with the task and texts are scanned where they lie: no shuffle,
and a text's cost does not depend on the others.

Nulls: a null text has no matches. Texts without words, and templates without
words, match nothing. Repeated rows are scanned each. Of ties between
placements of one template the leftmost comes first. Matches of one template
never overlap. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_TEMPLATE_WORDS = 200_000

#: Names of common licenses with their usual wordings.
LICENSE_NAMES = {
    "Apache-2.0": "Apache License, Version 2.0",
    "BSD-2-Clause": "BSD 2-Clause License",
    "BSD-3-Clause": "BSD 3-Clause License",
    "CC-BY-4.0": "CC BY 4.0",
    "CC-BY-NC-4.0": "CC BY-NC 4.0",
    "CC-BY-SA-4.0": "CC BY-SA 4.0",
    "GPL-2.0": "GNU General Public License, version 2",
    "GPL-3.0": "GNU General Public License, version 3",
    "LGPL-3.0": "GNU Lesser General Public License, version 3",
    "AGPL-3.0": "GNU Affero General Public License, version 3",
    "ISC": "ISC License",
    "MIT": "MIT License",
    "MPL-2.0": "Mozilla Public License, Version 2.0",
    "Unlicense": "Unlicense",
}
#: Sentences that put a work under a license.
STATEMENTS = [
    "Licensed under the {}.",
    "Licensed under {}.",
    "Released under the {}.",
    "Distributed under the terms of the {}.",
    "This work is licensed under the {}.",
    "This file is available under the {}.",
]
#: Notices as the licenses word them.
NOTICES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}

NOTICES["BSD-3-Clause"] = NOTICES["BSD-2-Clause"] + (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_GNU = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the "
    "Free Software Foundation, either version {version} of the License, or (at your option) any later version. This {what} is "
    "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
)
for _spdx, _what, _name, _version in [
    ("GPL-2.0-or-later", "program", "General Public License", "2"),
    ("LGPL-3.0-or-later", "library", "Lesser General Public License", "3"),
    ("AGPL-3.0-or-later", "program", "Affero General Public License", "3"),
]:
    NOTICES[_spdx] = _GNU.format(what=_what, name=_name, version=_version)
for _kind, _name in [("BY", "Attribution"), ("BY-NC", "Attribution-NonCommercial"), ("BY-SA", "Attribution-ShareAlike")]:
    NOTICES[f"CC-{_kind}-4.0"] = (
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this "
        f"Creative Commons {_name} 4.0 International Public License (\"Public License\"). To the extent this Public License may be "
        "interpreted as a contract, You are granted the Licensed Rights in consideration of Your acceptance of these terms and "
        "conditions, and the Licensor grants You such rights in consideration of benefits the Licensor receives from making the "
        "Licensed Material available under these terms and conditions."
    )
NOTICES["Unlicense"] = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
    "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial "
    "or non-commercial, and by any means."
)
#: Further paragraphs.
WARRANTIES = {
    "MIT": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
}


def default_templates() -> list[tuple[str, str, str]]:
    """``(license, template, text)``."""
    lines = [(spdx, f"statement-{i}", s.format(name)) for spdx, name in LICENSE_NAMES.items() for i, s in enumerate(STATEMENTS)]
    return lines + [(spdx, "notice", text) for spdx, text in NOTICES.items()] + [(spdx, "warranty", text) for spdx, text in WARRANTIES.items()]


_WORD = re.compile(r"[a-z0-9]+")


def lowered(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def winnow(prints: list[int], window: int) -> set[int]:
    """Places of the rightmost smallest fingerprint of every window."""
    if len(prints) <= window:
        return {min(range(len(prints)), key=lambda i: (prints[i], -i))} if prints else set()
    return {min(range(s, s + window), key=lambda i: (prints[i], -i)) for s in range(len(prints) - window + 1)}


def _better(other: tuple, match: tuple) -> bool:
    """Whether ``other``, of another license, explains the stretch of ``match`` better: more words matched less those missing."""
    if other[0] == match[0]:
        return False
    overlap = min(other[6], match[6]) - max(other[5], match[5])
    return overlap >= 0.8 * min(other[6] - other[5], match[6] - match[5]) and 2 * other[3] - other[4] > 2 * match[3] - match[4]


class LicenseIndex:
    """Inverted index of winnowed template fingerprints."""

    def __init__(self, templates: list[tuple[str, str, str]], k: int, window: int, band: int):
        self.k, self.band = k, band
        self.names = [(lic, name) for lic, name, _ in templates]
        self.words = [_WORD.findall(lowered(text)) for _, _, text in templates]
        if sum(map(len, self.words)) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words together")
        self.vocabulary = {w for ws in self.words for w in ws}
        #: The words of a fingerprint -> places (template, position).
        self.index: dict[tuple, list[tuple[int, int]]] = defaultdict(list)
        for t, ws in enumerate(self.words):
            grams = [tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)] or ([tuple(ws)] if ws else [])
            prints = [zlib.crc32(" ".join(g).encode()) for g in grams]
            for i in range(len(grams)) if len(grams) < window + k - 1 else winnow(prints, window):
                self.index[grams[i]].append((t, i))
        self.lengths = sorted({len(g) for g in self.index})

    def candidates(self, words: list[str]) -> dict[int, set[int]]:
        """Template -> diagonals (place in the text less place in the template)."""
        known = self.vocabulary
        found: dict[int, set[int]] = defaultdict(set)
        hits = [i for i, w in enumerate(words) if w in known]
        for n in self.lengths:
            # Only runs of n known words can be a fingerprint.
            for j in range(len(hits) - n + 1):
                i = hits[j]
                if hits[j + n - 1] == i + n - 1:
                    for t, at in self.index.get(tuple(words[i : i + n]), ()):
                        found[t].add(i - at)
        return found

    def align(self, template: list[str], words: list[str | None], diagonal: int) -> tuple[int, int, int]:
        """Banded alignment of the whole template with a stretch of the text
        around ``diagonal``: ``(matched words, first, last)`` of the placement
        that matches most words less skipped ones, leftmost of ties."""
        band, n = self.band, len(words)
        width = 2 * band + 1
        nothing = (0, 0, 0, -1, -1)  # score, matches, -first place, first, last
        row = [nothing] * width  # row[b]: template words so far against text up to place diagonal - band + b
        for i, w in enumerate(template):
            new = []
            for b in range(width):
                j = diagonal + i + b - band  # the text's word at this cell
                best = row[b + 1] if b + 1 < width else nothing
                best = (best[0] - 1, *best[1:])  # template word skipped
                score, matches, _, first, last = row[b]
                if 0 <= j < n and words[j] == w:
                    start = first if first >= 0 else j
                    best = max(best, (score + 1, matches + 1, -start, start, j))
                else:
                    best = max(best, (score - 1, matches, -first, first, last))
                if b and new[b - 1][3] >= 0:  # text word skipped
                    left = new[b - 1]
                    best = max(best, (left[0] - 1, *left[1:]))
                new.append(best)
            row = new
        _, matches, _, first, last = max(row)
        return matches, first, last

    def scan(self, text: str, min_coverage: float) -> list[tuple[str, str, float, int, int, int, int, bool]]:
        """``(license, template, coverage, matched words, template words, start, end, best)``, places in characters."""
        low = lowered(text)
        words = _WORD.findall(low)
        found = self.candidates(words)
        if not found:
            return []
        spans = [m.span() for m in _WORD.finditer(low)]
        out = []
        for t, diagonals in found.items():
            template = self.words[t]
            covered, free = None, list(words)
            for d in sorted(diagonals):
                if covered is not None and d - covered <= self.band // 2:
                    continue  # the band around the last diagonal holds this one
                covered = d
                while True:
                    matches, first, last = self.align(template, free, d)
                    if not matches or matches < min_coverage * len(template):
                        break
                    out.append((*self.names[t], matches / len(template), matches, len(template), spans[first][0], spans[last][1]))
                    free[first : last + 1] = [None] * (last + 1 - first)  # and whatever else the band holds
        return sorted(((*m, not any(_better(o, m) for o in out)) for m in out), key=lambda m: (m[5], m[6], m[0], m[1]))


MATCHES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("license", T.StringType()),
        T.StructField("template", T.StringType()),
        T.StructField("coverage", T.DoubleType()),
        T.StructField("matched_words", T.LongType()),
        T.StructField("template_words", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("best", T.BooleanType()),
    ]
)


def scan_licenses(
    docs: DataFrame,
    templates: list[tuple[str, str, str]] | None = None,
    min_coverage: float = 0.8,
    k: int = 3,
    window: int = 3,
    band: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per match of a template in a text."""
    index = LicenseIndex(templates if templates is not None else default_templates(), k, window, band)
    kinds = [pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, *m) for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for m in index.scan(text or "", min_coverage)]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=MATCHES.names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, MATCHES)
