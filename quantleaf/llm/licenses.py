"""License scans by patience alignment.

A text is compared with license statements and notices word by word (lower case, punctuation dropped). A window of the
text is aligned to a template like this: equal words at both ends are matched; of the rest, words that occur
once in the window and once in the template are anchors; the longest increasing subsequence of their
positions is matched, and each gap between anchors is aligned in the same way. Coverage is the share of
the template's words that are matched. A license is found where a window of twice the template's length reaches
``MIN_COVERAGE`` and the words that tell the license from others are matched: in statements of less than ``NOTICE`` words all but
``COMMON`` ones, no farther apart than in the template; in notices the version's number after "version" and the name of
the GNU license. So another name or version is another license or none, whatever the coverage.

Windows that share too few words with the template, repeats counted, to reach the coverage are passed over, which loses nothing:
no alignment matches more. The templates are a fixed table, sent to the tasks; texts are read once, without a shuffle.

Matches are listed by the number of matched words, then by coverage, name and place; of matches that overlap, only the first
is. Defined results: a null or empty text has no license (coverage 0, empty list). Statements repeated in a text are listed each. Repeated rows and equal or null ids give
one row each. An empty table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

MIN_COVERAGE = 0.8
SLACK = 8                  # words that a window may hold beyond twice the template's length
NOTICE = 20                # words from which a template is a notice
COMMON = frozenset("code is licensed program released software the this under version work".split())
_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")

#: Wording of public licenses.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0 notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
        BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.""",
    "agpl-3.0 text": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "apache-1.1": "Licensed under the Apache License, Version 1.1.",
    "apache-2.0 text": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "bsd": "Released under the BSD License.",
    "bsd-2-clause": "Released under the BSD 2-Clause License.",
    "bsd-3-clause": "Released under the BSD 3-Clause License.",
    "bsd-3-clause notice": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
        3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
        derived from this software without specific prior written permission.""",
    "bsd-2-clause notice": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc0-1.0": "Licensed under CC0 1.0.",
    "cc0-1.0 notice": """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights
        to this software to the public domain worldwide. This software is distributed without any warranty.""",
    "cc0-1.0 text": "Creative Commons Legal Code CC0 1.0 Universal",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2.0 notice": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "gpl-2.0 text": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl-3.0 text": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "isc": "Released under the ISC License.",
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-2.1 notice": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later
        version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "lgpl-2.1 text": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "lgpl-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "lgpl-3.0 text": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "isc notice": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit": "Released under the MIT License.",
    "mit notice": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
        use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
        the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
        shall be included in all copies or substantial portions of the Software.""",
    "mpl-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "mpl-2.0 notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}
TEMPLATES |= {f"cc-{kind}-{version}": f"Licensed under CC {kind.upper()} {version}."
              for kind in ("by", "by-nc", "by-nc-nd", "by-nc-sa", "by-nd", "by-sa") for version in ("3.0", "4.0")}
TEMPLATES |= {f"{name} spdx": f"SPDX-License-Identifier: {name}" for name in (
    "agpl-3.0-only", "agpl-3.0-or-later", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "cc-by-4.0", "cc-by-sa-4.0", "cc0-1.0", "gpl-2.0-only",
    "gpl-2.0-or-later", "gpl-3.0-only", "gpl-3.0-or-later", "isc", "lgpl-2.1-only", "lgpl-2.1-or-later", "lgpl-3.0-only", "lgpl-3.0-or-later",
    "mit", "mpl-2.0")}


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _increasing(positions: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence."""
    tails, tail_index, before = [], [], [-1] * len(positions)
    for i, p in enumerate(positions):
        k = bisect_left(tails, p)
        if k == len(tails):
            tails.append(p)
            tail_index.append(i)
        else:
            tails[k], tail_index[k] = p, i
        before[i] = tail_index[k - 1] if k else -1
    out, i = [], tail_index[-1] if tail_index else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Patience alignment: matched positions (in a, in b), both increasing."""
    matched, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: i for i, w in enumerate(b[b0:b1], start=b0) if in_b[w] == 1 and in_a.get(w) == 1}
        anchors = [(i, place[a[i]]) for i in range(a0, a1) if a[i] in place]
        chosen = [anchors[k] for k in _increasing([q for _, q in anchors])]
        if not chosen:
            continue
        matched.extend(chosen)
        for (i, p), (j, q) in zip([(a0 - 1, b0 - 1), *chosen], [*chosen, (a1, b1)], strict=True):
            todo.append((i + 1, j, p + 1, q))
    return sorted(matched)


def identifying(words: list[str]) -> list[list[int]]:
    """Places of a template's words that must be matched; those of one list no farther apart than in the template."""
    if len(words) < NOTICE:
        return [[i for i, w in enumerate(words) if w not in COMMON]]
    return ([[i] for i, w in enumerate(words) if w in ("affero", "lesser")]
            + [[i, i + 1] for i, w in enumerate(words[:-1]) if w in ("v", "version") and words[i + 1][0].isdigit()])


def names_it(pairs: list[tuple[int, int]], groups: list[list[int]]) -> bool:
    at = {p: i for i, p in pairs}
    return all(p in at for g in groups for p in g) and all(at[q] - at[p] <= q - p for g in groups for p, q in zip(g, g[1:], strict=False))


class Scanner:
    def __init__(self, templates: dict[str, str], min_coverage: float = MIN_COVERAGE):
        self.templates = [(name, words_of(text)) for name, text in sorted(templates.items())]
        self.least = [max(1, -int(-min_coverage * len(words) // 1)) for _, words in self.templates]
        self.identifying = [identifying(words) for _, words in self.templates]
        self.times = [Counter(words) for _, words in self.templates]
        self.holders: dict[str, list[int]] = {}
        for k, (_, words) in enumerate(self.templates):
            for w in set(words):
                self.holders.setdefault(w, []).append(k)

    def scan(self, text: str | None) -> list[dict]:
        """Licenses of a text: name, coverage, first_word and end_word of the matched words; best first."""
        words = words_of(text)
        hits: dict[int, list[int]] = {}
        holders = self.holders
        for i, w in enumerate(words):
            if w in holders:
                for k in holders[w]:
                    hits.setdefault(k, []).append(i)
        found = []
        for k, places in hits.items():
            name, template = self.templates[k]
            width, least = 2 * len(template) + SLACK, self.least[k]
            need, have, shared = self.times[k], Counter(), 0     # shared: words of window and template in common, with repeats
            i, end = 0, 0
            while i < len(places):
                while end < len(places) and places[end] < places[i] + width:
                    w = words[places[end]]
                    have[w] += 1
                    shared += have[w] <= need[w]
                    end += 1
                following = i + 1       # a later start may match more of the same statement
                if shared >= least:
                    for size in (width, len(template) + SLACK):
                        window = words[places[i]:places[i] + size]
                        pairs = align(window, template)
                        found_it = len(pairs) >= least and names_it(pairs, self.identifying[k])
                        if found_it:
                            break
                    if found_it:
                        first, last = places[i] + pairs[0][0], places[i] + pairs[-1][0] + 1
                        found.append({"license": name, "coverage": len(pairs) / len(template), "first_word": first, "end_word": last,
                                      "words": len(pairs)})
                        if len(pairs) == len(template):
                            following = bisect_left(places, last)
                for p in places[i:following]:
                    w = words[p]
                    shared -= have[w] <= need[w]
                    have[w] -= 1
                i = following
        found.sort(key=lambda f: (-f["words"], -f["coverage"], f["license"], f["first_word"]))
        kept: list[dict] = []       # of matches that overlap, the one with the most matched words
        for f in found:
            if all(f["end_word"] <= g["first_word"] or g["end_word"] <= f["first_word"] for g in kept):
                kept.append(f)
        return kept


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
                  min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per document: doc_id, found (array of license, coverage, first_word, end_word; best first)."""
    scanner = Scanner(templates or TEMPLATES, min_coverage)
    kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int32()), ("end_word", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                found = [[{c: f[c] for c in ("license", "coverage", "first_word", "end_word")} for f in scanner.scan(t)]
                         for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, kind)], ["doc_id", "found"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, "
                                "found array<struct<license:string,coverage:double,first_word:int,end_word:int>>")


def op5_query(docs: DataFrame) -> DataFrame:
    first = F.get("found", F.lit(0))
    return scan_licenses(docs).select("doc_id", F.size("found").cast("long").alias("n_found"), first["license"].alias("license"),
                                      F.coalesce(first["coverage"], F.lit(0.0)).alias("coverage"), "found")
