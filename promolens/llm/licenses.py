"""License scan by patience alignment.

A text and a template are word lists. Words that are unique in both are anchors; the longest increasing subsequence of their
positions fixes a first alignment, and the gaps between anchors are aligned in the same way, with words unique within the
gap. Equal words at a gap's two ends are matched first; a gap without anchors matches nothing more. Coverage is the
share of a template's words that are aligned; a template is found where it reaches COVERED.

A text that reaches COVERED must hold one of any set of template words that makes up more than the rest; the rarest such set
of each template is looked for by Spark first, exactly, so that only texts with a chance reach Python. In the text, spans
around such words, as long as the template on both sides, are aligned on their own, so that a license is found
anywhere in a long text, and more than once. Copies close together hide each other's words from the anchors; where a span aligns too
little or too far apart, windows of about the template's length, at each place that a telling word may have in it, are aligned instead.

Defined results: null, empty and license-free texts give no finds (the query returns them with empty lists); equal coverage of
overlapping spans keeps the earlier and longer one; repeated rows and null ids pass through; extra columns are kept, but one
named finds is replaced, and none may be named __likely.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import ascii_lower, table

COVERED = 0.8

#: Notices and parts of license texts (grant and disclaimer apart) as their authors publish them.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "all-rights-reserved": "All rights reserved.",
    "gpl-3.0-line": "This program is licensed under the GNU General Public License, version 3.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies.""",
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "mit-disclaimer": """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "bsd-disclaimer": """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "bsd-3-clause-endorsement": """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.""",
    "isc-disclaimer": """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES
OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "lgpl-3.0": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as
published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.""",
    "agpl-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "cc-by-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd-line": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-line": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-line": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}
#: Templates that differ in a word or two: of overlapping finds only the one with the most matched words stays (of equal ones, the better covered).
ALIKE = [{k for k in TEMPLATES if k.startswith("cc-by")}, {"gpl-3.0", "lgpl-3.0", "agpl-3.0"}]

_WORDS = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
#: The commonest words of the templates; a template's telling words are any others.
_PLAIN = set("a all and any are be by copy do file following for free in is may not of on or program software that the this to under use with without you version".split())


def words(text: str) -> list[str]:
    return _WORDS.findall(text.translate(_LOWER))


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rising(at: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience piles."""
    tops, where, before = [], [], []
    for i, x in enumerate(at):
        k = bisect_left(tops, x)
        before.append(where[k - 1] if k else -1)
        tops[k : k + 1], where[k : k + 1] = [x], [i]
    out, i = [], where[-1] if where else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched positions of two word lists, ascending."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        once_a = {w for w, n in Counter(a[a0:a1]).items() if n == 1}
        once = {w for w, n in Counter(b[b0:b1]).items() if n == 1 and w in once_a}
        if not once:
            continue
        in_b = {w: k for k, w in enumerate(b[b0:b1], b0) if w in once}
        anchors = [(k, in_b[w]) for k, w in enumerate(a[a0:a1], a0) if w in once]
        kept = [anchors[i] for i in rising([y for _, y in anchors])]
        out += kept
        for (x0, y0), (x1, y1) in zip([(a0 - 1, b0 - 1), *kept], [*kept, (a1, b1)], strict=True):
            todo.append((x0 + 1, x1, y0 + 1, y1))
    return sorted(out)


def telling(template: list[str], covered: float = COVERED) -> set[str]:
    """Template words of which a covered text holds one: they make up more than what coverage can do without."""
    spare, out, n = len(template) - -(-round(covered * 1000) * len(template) // 1000), set(), 0
    counts = Counter(template)
    for w in sorted(counts, key=lambda w: (w in _PLAIN, -len(w), w)):
        if n > spare:
            break
        out.add(w)
        n += counts[w]
    return out


def apart(t: list[str], lo: int, hi: int, template: list[str], marks: set[str], covered: float) -> list[tuple[int, int, int]]:
    """(matched words, first word, end word) of the template's copies in a span, each aligned in a window of its own, in order of position."""
    n, counts = len(template), Counter(template)
    enough, places = covered * n - 1e-9, {w: [k for k, x in enumerate(template) if x == w] for w in marks}
    likely = lambda x, y: sum(min(c, counts[w]) for w, c in Counter(t[x:y]).items() if w in counts) >= enough
    if not likely(lo, hi):
        return []
    starts = {at - k for at in range(lo, hi) if t[at] in marks for k in places[t[at]]}
    spare, found = n - -(-round(covered * 1000) * n // 1000), []
    for x, y in sorted({(max(lo, s - wide), min(hi, s + n + wide)) for s in starts for wide in (0, spare)}):
        if likely(x, y) and len(pairs := aligned(t[x:y], template)) >= enough:
            found.append((len(pairs), x + pairs[0][0], x + pairs[-1][0] + 1))
    kept: list = []
    for f in sorted(set(found), key=lambda f: (-f[0], f[2] - f[1], f[1])):
        at = bisect_left(kept, f[1], key=lambda k: k[1])
        if (at == 0 or kept[at - 1][2] <= f[1]) and (at == len(kept) or f[2] <= kept[at][1]):
            kept.insert(at, f)
    return kept


def scan(text: str, templates: dict[str, list[str]], covered: float = COVERED) -> list[tuple[str, float, int, int]]:
    """(license, coverage, first word, end word) of all finds, in order of position."""
    t, out = words(text), []
    for name, template in templates.items():
        marks, n, spans = telling(template, covered), len(template), []
        for at in (k for k, w in enumerate(t) if w in marks):
            lo, hi = max(0, at - n), min(len(t), at + n + 1)
            if spans and lo <= spans[-1][1]:
                spans[-1][1] = hi
            else:
                spans.append([lo, hi])
        while spans:
            lo, hi = spans.pop()
            if hi - lo > 4 * n:  # a long span holds several: cut it, each piece overlapping the next by twice the template
                spans += [[lo, lo + 4 * n], [lo + 2 * n, hi]]
                continue
            pairs = aligned(t[lo:hi], template)
            found = [(len(pairs), lo + pairs[0][0], lo + pairs[-1][0] + 1)] if len(pairs) >= covered * n - 1e-9 else []
            if not found or found[0][2] - found[0][1] > (2 - covered) * n:
                found = apart(t, lo, hi, template, marks, covered) or found
            if found:
                out += [(name, k / n, first, end) for k, first, end in found]
                spans += [[x, y] for x, y in zip([lo, *[f[2] for f in found]], [*[f[1] for f in found], hi], strict=True) if y - x >= covered * n]
    best: dict = {}
    for f in out:
        key = (f[0], f[2])
        if key not in best or f[1] > best[key][1]:
            best[key] = f
    kept: list = []
    for f in sorted(best.values(), key=lambda f: (f[0], -f[1], f[2], -f[3])):
        if not any(k[0] == f[0] and f[2] < k[3] and k[2] < f[3] for k in kept):
            kept.append(f)
    for family in ALIKE:
        own = sorted((f for f in kept if f[0] in family), key=lambda f: (-round(f[1] * len(templates[f[0]])), -f[1], f[0]))
        kept = [f for f in kept if f[0] not in family]
        for f in own:
            if not any(k[0] in family and f[2] < k[3] and k[2] < f[3] for k in kept):
                kept.append(f)
    return sorted(kept, key=lambda f: (f[2], f[3], f[0]))


SCHEMA = "array<struct<license string, coverage double, first int, end int>>"


def scanned(docs: DataFrame, templates: dict[str, str] | None = None, covered: float = COVERED) -> DataFrame:
    """docs and ``finds``; of texts that can't reach the coverage, an empty array."""
    lists = {k: words(v) for k, v in (templates or TEMPLATES).items()}
    marks = sorted(set().union(*(telling(t, covered) for t in lists.values())))
    likely = F.coalesce(ascii_lower(F.col("text")).rlike("(?<![a-z0-9])(?:" + "|".join(map(re.escape, marks)) + ")(?![a-z0-9])"), F.lit(False))
    docs = docs.drop("finds").withColumn("__likely", likely)
    names, kind = [c for c in docs.columns if c != "__likely"], pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first", pa.int32()), ("end", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]):
        at = names.index("text")
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                b = whole.slice(k, 512)
                finds = [[dict(zip(("license", "coverage", "first", "end"), f, strict=True)) for f in scan(t.as_py() or "", lists, covered)] if go.as_py() else [] for t, go in zip(b.column(at), b.column(len(names)), strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(finds, kind)], [*names, "finds"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.drop("__likely").schema)
    return docs.mapInArrow(work, f"{fields}, finds {SCHEMA}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.array_max(F.transform("finds", lambda f: f["coverage"]))
    return d.select("doc_id", F.size("finds").cast("long").alias("n_finds"), F.array_join(F.array_sort(F.array_distinct(F.transform("finds", lambda f: f["license"]))), ",").alias("licenses"), F.coalesce(best, F.lit(0.0)).alias("coverage"), "finds")


QUERIES, ORACLES = {"op3_licenses": query}, {}
