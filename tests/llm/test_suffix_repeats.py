"""Substring deduplication against a dictionary of all windows."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from quantleaf.llm import suffix_repeats

from .helpers import WORD, awkward_docs, documents, empty_docs


def brute_force(rows, window=50):
    least = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in split:
        for p in range(len(w) - window + 1 if i is not None else 0):
            k = tuple(w[p:p + window])
            least[k] = min(i, least.get(k, i))
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - window + 1 if i is not None else 0):
            if least[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def digests(df):
    return df.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def corpus(seed, n=120, vocabulary=40):
    """Texts of few words with shared passages of 45 to 120 words, copies, runs of one word, shuffled ids."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(vocabulary)}"
    passages = [[word() for _ in range(rnd.randint(45, 120))] for _ in range(8)] + [["same"] * 90, ["a", "b"] * 40]
    rows = []
    for i in rnd.sample(range(1000), n):
        words = []
        for _ in range(rnd.randint(0, 4)):
            words += [word() for _ in range(rnd.randint(0, 30))]
            p = rnd.choice(passages)
            words += p[rnd.randint(0, 5):len(p) - rnd.randint(0, 5)]
        rows.append((i, rnd.choice([" ", "  ", "\n"]).join(words)))
    return rows + [(i + 1000, t) for i, t in rows[:10]] + rows[:3] + [(None, rows[0][1]), (None, None), (5000, None)]


def test_deep_nodes():
    rnd = random.Random(1)
    words = np.array([rnd.randrange(3) for _ in range(4000)], np.uint64)
    for depth in (5, 8, 11):
        starts = np.arange(len(words) - depth + 1)
        order, node = suffix_repeats.deep_nodes(words, starts, depth)
        seen = {}
        for s, k in zip(starts[order].tolist(), node.tolist(), strict=True):
            assert seen.setdefault(tuple(words[s:s + depth]), k) == k
        assert len(set(seen.values())) == len(seen) == node[-1] + 1


def test_least_places():
    values = np.array([random.Random(2).randrange(9) for _ in range(500)], np.uint64)
    for span in (1, 2, 3, 7, 8, 35):
        assert suffix_repeats.least_places(values, span).tolist() == [i + int(np.argmin(values[i:i + span])) for i in range(len(values) - span + 1)]


def test_random_corpora(spark):
    for seed in range(3):
        rows = corpus(seed)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        want = brute_force(rows)
        assert sum(r[2] > 0 for r in want) > 50
        assert got(suffix_repeats.op12_query(docs)) == want
        # small groups and blocks: most trees take the whole window as prefix
        assert got(digests(suffix_repeats.remove_repeats(docs, group=4, at_once=10, block_bytes=3000))) == want


def test_other_window(spark):
    rows = corpus(7, n=60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(digests(suffix_repeats.remove_repeats(docs, window=20, gram=5))) == brute_force(rows, 20)


def test_documents_and_awkward_rows(spark):
    for docs in (documents(spark), awkward_docs(spark)):
        assert got(suffix_repeats.op12_query(docs)) == brute_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert suffix_repeats.op12_query(empty_docs(spark)).collect() == []


def test_maximal_repeats(spark):
    rows = [r for r in corpus(11, n=80) if r[0] is not None]
    rows = list({i: (i, t) for i, t in rows}.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    words = {i: WORD.findall(t or "") for i, t in rows}
    found = suffix_repeats.repeats(docs).collect()
    removed = {r.doc_id: r.n_removed for r in suffix_repeats.op12_query(docs).collect()}
    covered = {}
    for r in found:
        piece = words[r.doc_id][r.first_word:r.first_word + r.n_words]
        assert r.source < r.doc_id and len(piece) == r.n_words >= 50
        for p in range(len(piece) - 49):
            window = piece[p:p + 50]
            assert any(words[r.source][q:q + 50] == window for q in range(len(words[r.source]) - 49))
        covered.setdefault(r.doc_id, set()).update(range(r.first_word, r.first_word + r.n_words))
    assert {i: len(c) for i, c in covered.items()} == {i: n for i, n in removed.items() if n}
