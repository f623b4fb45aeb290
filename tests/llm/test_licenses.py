"""License scans: patience alignment against brute force, planted statements."""

import random
from itertools import combinations

from quantleaf.llm import licenses

from .helpers import SENTENCE, awkward_docs, documents, empty_docs


def test_alignment_is_increasing_and_equal():
    rnd = random.Random(0)
    for _ in range(300):
        a, b = ([rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 12))] for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))


def test_longest_increasing_subsequence():
    rnd = random.Random(1)
    for _ in range(100):
        values = rnd.sample(range(50), rnd.randint(0, 9))
        got = [values[i] for i in licenses._increasing(values)]
        best = max((n for n in range(len(values) + 1) if any(list(c) == sorted(c) for c in combinations(values, n))), default=0)
        assert got == sorted(got) and len(got) == best


def test_distinct_words_align_like_the_longest_common_subsequence():
    rnd = random.Random(2)
    for _ in range(100):
        a, b = (rnd.sample("abcdefghijkl", 8) for _ in range(2))
        table = [[0] * 9 for _ in range(9)]
        for i in range(8):
            for j in range(8):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert len(licenses.align(a, b)) == table[8][8]


def test_planted_statements():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    assert scanner.scan(None) == [] and scanner.scan(SENTENCE * 50) == []
    for name, text in licenses.TEMPLATES.items():
        found = scanner.scan(SENTENCE * 2 + text + "\n" + SENTENCE)
        assert found[0]["license"] == name and found[0]["coverage"] == 1, name
        words = text.split()
        if len(words) >= 20:
            changed = words[:10] + ["changed", "words"] + words[11:-3]
            found = scanner.scan(SENTENCE + " ".join(changed))
            assert found[0]["license"] == name and 0.8 <= found[0]["coverage"] < 1, name
    twice = scanner.scan(("Released under the MIT License. " + SENTENCE) * 2)
    assert [f["license"] for f in twice] == ["mit", "mit"] and twice[0]["end_word"] <= twice[1]["first_word"]


def test_near_misses_are_not_another_license():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    cases = [
        ("Released under the BSD License.", "bsd"), ("Licensed under CC BY 3.0.", "cc-by-3.0"), ("Licensed under CC BY 2.0.", None),
        ("Apache License, Version 1.1", None), ("Licensed under the Apache License, Version 1.1", "apache-1.1"),
        ("This work is licensed under the GNU General Public License, version 2", "gpl-2.0"),
        ("This work is licensed under the GNU General Public License, version 1", None),
        ("This work is licensed under the GNU Lesser General Public License, version 3", "lgpl-3.0"),
        ("It was released under the band's own license.", None), ("Licensed under CC BY-SA 4.0", "cc-by-sa-4.0"), ("Released under MIT License", "mit"),
        ("Released under the eye of MIT staff, who hold a license.", None), ("all of their rights are reserved", None),
        (licenses.TEMPLATES["gpl-3.0 notice"].replace("version 3", "version 2"), "gpl-2.0 notice"),
        (licenses.TEMPLATES["gpl-3.0 notice"].replace("version 3", "version 1"), None),
        (licenses.TEMPLATES["bsd-2-clause notice"], "bsd-2-clause notice"), (licenses.TEMPLATES["bsd-3-clause notice"], "bsd-3-clause notice"),
    ]
    for text, want in cases:
        for around in ("", SENTENCE):
            found = scanner.scan(around + text + " " + around)
            assert (found[0]["license"] if found else None) == want, text


def test_every_statement_of_the_documents_is_found(spark):
    docs = documents(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = {r.doc_id: r for r in licenses.op5_query(docs).collect()}
    assert rows.keys() == texts.keys()
    for name in ("mit", "apache-2.0", "gpl-3.0", "cc-by-nc-4.0", "all-rights-reserved"):
        for i, text in texts.items():
            if licenses.TEMPLATES[name] in text:
                assert name in [f.license for f in rows[i].found]
    for r in rows.values():
        assert (r.n_found, r.license is None) == (len(r.found), not r.found) and r.coverage == (r.found[0].coverage if r.found else 0)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = licenses.op5_query(docs).collect()
    assert len(rows) == docs.count() and all(r.n_found == 0 and r.coverage == 0 for r in rows)
    assert licenses.op5_query(empty_docs(spark)).collect() == []


def scan_all(scanner, text):
    """``scan`` without passing over any window."""
    class Everything(dict):
        def __missing__(self, key):
            return 0

    times = scanner.times
    scanner.times = [Everything({w: 10 ** 9 for w in words}) for _, words in scanner.templates]      # every word counts as shared
    least, scanner.least = scanner.least, scanner.least
    try:
        return scanner.scan(text)
    finally:
        scanner.times, scanner.least = times, least


def test_random_deletions_are_found_and_no_window_is_lost():
    rnd = random.Random(6)
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES.items():
        words = licenses.words_of(text)
        if len(words) < licenses.NOTICE:
            continue
        keep_always = {p for g in licenses.identifying(words) for p in g}
        for _ in range(6):
            drop = rnd.sample([i for i in range(1, len(words) - 1) if i not in keep_always], len(words) - -int(-0.82 * len(words) // 1))
            kept = [w for i, w in enumerate(words) if i not in set(drop)]
            found = scanner.scan(SENTENCE + " ".join(kept) + " " + SENTENCE)
            assert found == scan_all(scanner, SENTENCE + " ".join(kept) + " " + SENTENCE)
            pairs = licenses.align(kept, words)
            if len(pairs) >= 0.8 * len(words) and licenses.names_it(pairs, licenses.identifying(words)):
                assert found and found[0]["coverage"] >= 0.8, (name, len(pairs))
    for _ in range(30):
        parts = [rnd.choice(list(licenses.TEMPLATES.values())).split() for _ in range(3)]
        text = " ".join(w for p in parts for w in p if rnd.random() > 0.1)
        assert scanner.scan(text) == scan_all(scanner, text)


def test_spdx_lines():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for text, want in (("// SPDX-License-Identifier: MIT\nint x;", "mit spdx"), ("SPDX-License-Identifier: Apache-2.0", "apache-2.0 spdx"),
                       ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3.0-or-later spdx"), ("SPDX-License-Identifier: Unknown", None)):
        found = scanner.scan(text)
        assert (found[0]["license"] if found else None) == want
