"""Reversed ranked search against a direct evaluation of the formula."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from quantleaf.llm import lexical_search

from .helpers import awkward_docs, awkward_texts, documents, empty_docs

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in set(items):
        found = []
        for doc_id, b in bags:
            m = 25 + 75 * sum(b.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in terms(text) if t in b)
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        out += [(item_id, r, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k], 1)]
    return sorted(map(str, out))


def rows(df):
    return sorted(str((r.item_id, r["rank"], r.doc_id, r.score)) for r in df.collect())


def test_terms():
    for t in awkward_texts():
        assert [w.decode() for w in lexical_search.terms(t)] == terms(t)


def test_equals_the_formula(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "CELLS", 100)
    monkeypatch.setattr(lexical_search, "EXPANDED", 500)
    docs = documents(spark).select("doc_id", "text").repartition(3)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    given = [(r.item_id, r.text) for r in items.collect()] + [(7, None), (8, ""), (9, "the THE The ça"), (9, "the THE The ça"), (None, "the")]
    table = spark.createDataFrame(given, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("score", F.lit("x"))
    want = brute_force([(r.doc_id, r.text) for r in docs.collect()], [g for g in given if g[1] is not None])
    assert rows(lexical_search.op13_query(docs, table)) == want
    assert rows(lexical_search.search(docs, table, index_bytes=500)) == want            # several blocks of items
    monkeypatch.setattr(lexical_search, "EXACT", 0)
    assert rows(lexical_search.op13_query(docs, table)) == want                         # sums in integers


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    pairs = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = [(1, "quick brown FOX"), (2, "extra"), (3, "no id here at all"), (4, "中文"), (5, "   "), (6, "unknownterm")]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert rows(lexical_search.op13_query(docs, table)) == brute_force(pairs, items)
    one = lexical_search.search(spark.createDataFrame([(5, "a b"), (3, "a b"), (4, "a b"), (9, "z")], "doc_id long, text string"),
                                spark.createDataFrame([("x", "b")], "item_id string, text string"), k=2)
    assert [(r["rank"], r.doc_id) for r in one.orderBy("rank").collect()] == [(1, 3), (2, 4)]
    assert lexical_search.op13_query(empty_docs(spark), table).collect() == []
    assert lexical_search.op13_query(docs, table.limit(0)).collect() == []
