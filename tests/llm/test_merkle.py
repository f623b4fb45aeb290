"""Merkle fingerprints against brute force."""

import hashlib
from collections import Counter, defaultdict

import xxhash

from quantleaf.llm import merkle

from .helpers import SENTENCE, awkward_docs, documents, empty_docs


def brute_force(rows):
    """Multiset of (id, n_chars, edited digest, next text) for rows of (id, text)."""
    tie = lambda t: xxhash.xxh64_intdigest(t.encode(), seed=42)
    signed = lambda h: h - (1 << 64) if h >= 1 << 63 else h
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), signed(tie(r[1]))))
    out = Counter()
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        cut = len(t) // 3
        changed = t[:len(t) - cut] + following[:cut]
        out[i, len(t), hashlib.sha256(changed.encode()).hexdigest(),
            round(merkle.compare(fingerprint(t), fingerprint(changed)), 9), round(merkle.compare(fingerprint(t), fingerprint(following)), 9)] += 1
    return out


def fingerprint(text):
    return merkle.fingerprint(merkle.trees([text])[0])


def flat_dice(a, b):
    """Dice coefficient of the word groups alone, without the tree."""
    groups = [Counter(merkle.word_groups([t])[0][0].tolist()) for t in (a, b)]
    total = sum(groups[0].values()) + sum(groups[1].values())
    return 2 * sum((groups[0] & groups[1]).values()) / total if total else 0.0


def test_against_brute_force(spark):
    for docs in (awkward_docs(spark), documents(spark), documents(spark).limit(1)):
        rows = merkle.op3_query(docs).collect()
        assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows) == brute_force(
            [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert merkle.op3_query(empty_docs(spark)).collect() == []


def test_equal_texts_have_equal_fingerprints(spark):
    texts = defaultdict(set)
    rows = {r.doc_id: r.text for r in documents(spark).collect()}
    for r in merkle.op3_query(documents(spark)).collect():
        texts[rows[r.doc_id]].add(r.fingerprint)
        assert r.fingerprint == fingerprint(rows[r.doc_id])
    assert all(len(f) == 1 for f in texts.values()) and len({f for s in texts.values() for f in s}) == len(texts)


def test_edits_are_located():
    lines = [f"Paragraph {i} says this and that. {SENTENCE}" for i in range(60)]
    changed = lines.copy()
    changed[17] = "Something else."
    del changed[40]
    a, b = merkle.trees(["\n".join(lines), "\n".join(changed)])
    assert a.root != b.root
    found = merkle.compare_trees(a, b)
    assert (found.left, found.right) == ([17, 40], [17])
    assert merkle.compare_trees(a, a) == merkle.Comparison(1.0, [], [])
    assert 0.9 < merkle.compare(fingerprint("\n".join(lines)), fingerprint("\n".join(changed))) < 1


def test_likeness():
    assert merkle.compare(fingerprint(""), fingerprint("")) == 1
    assert merkle.compare(fingerprint(SENTENCE), fingerprint("")) == 0
    assert merkle.compare(fingerprint(SENTENCE), fingerprint(SENTENCE + " ")) < 1      # white space alone differs
    assert merkle.compare(fingerprint(SENTENCE), fingerprint("Nothing of the kind is said here.")) == 0


def test_the_walk_gives_the_coefficient_of_all_groups(spark):
    texts = [r.text or "" for r in awkward_docs(spark).select("text").collect()] + [r.text for r in documents(spark).collect()]
    for a, b in zip(texts, texts[1:], strict=False):
        for other in (b, merkle.edited(a, b)):
            got = merkle.compare(fingerprint(a), fingerprint(other))
            if a == other:
                assert got == 1
            else:      # texts that differ in white space alone stay below 1
                assert got < 1 and (abs(got - flat_dice(a, other)) < 1e-9 or flat_dice(a, other) == 1)


def test_equal_branches_are_not_entered(monkeypatch):
    lines = [f"Paragraph {i} says this and that. {SENTENCE}" for i in range(400)]
    a, b = merkle.trees(["\n".join(lines), "\n".join([*lines[:200], "Another line.", *lines[201:]])])
    seen = []
    monkeypatch.setattr(merkle, "_open_groups", lambda t, paragraphs: seen.append(len(paragraphs)) or t.groups[:0])
    merkle.compare_trees(a, b)
    assert seen == [1, 1]


def test_fingerprints_hold_their_tree(spark):
    for r in awkward_docs(spark).collect():
        tree = merkle.trees([r.text or ""])[0]
        back = merkle.parsed(merkle.fingerprint(tree))
        assert (back.root, back.sections, back.paragraphs) == (tree.root, tree.sections, tree.paragraphs)
        assert back.groups.tolist() == tree.groups.tolist() and back.limits.tolist() == tree.limits.tolist()


def test_differing_paragraphs_are_returned(spark):
    text = "\n".join(f"Paragraph {i} says this and that. {SENTENCE}" for i in range(30))
    docs = spark.createDataFrame([(2, text), (1, "Nothing of the kind. " * 40)], "doc_id long, text string")
    found = {r.doc_id: r.differing for r in merkle.op3_query(docs).collect()}
    assert found[2] == list(range(found[2][0], 30)) and 18 <= found[2][0] <= 20


def test_frequent_ids_are_dealt_by_text(spark):
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else 1000 + i, f"{SENTENCE} {i}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    dealt = merkle.with_next(docs).collect()
    sizes = Counter(r.range for r in dealt)
    assert sum(r.copy for r in dealt) == len(sizes) and max(sizes.values()) < 120
    got = merkle.op3_query(docs).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == brute_force(rows)
