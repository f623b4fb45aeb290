"""Quality discriminant and toxicity: brute force on small data, held-out accuracy on the given tables."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quantleaf.llm import quality_qda, toxicity
from quantleaf.llm.common import buffer_of

from .helpers import SENTENCE, awkward_docs, awkward_texts, empty_docs, labels

MEDIUM = "/root/testdata/sf0.01"


def statistics(texts):
    return quality_qda.statistics(*buffer_of(pa.array(texts, pa.string())))


def test_statistics_match_brute_force():
    texts = [t or "" for t in awkward_texts()]
    got = statistics(texts)
    assert got.shape == (len(texts), len(quality_qda.FEATURES)) and np.isfinite(got).all()
    column = {f: got[:, k] for k, f in enumerate(quality_qda.FEATURES)}
    space = " \t\n\x0b\x0c\r"
    for i, t in enumerate(texts):
        words = [w for w in "".join(" " if c in space else c for c in t).split(" ") if w]
        assert np.isclose(column["words"][i], np.log1p(len(words)))
        assert np.isclose(column["distinct_words"][i], np.log((len(words) - len(set(words)) + 0.5) / (len(words) + 1)))
        pairs = list(zip(words, words[1:], strict=False))
        assert np.isclose(column["distinct_pairs"][i], np.log((len(pairs) - len(set(pairs)) + 0.5) / (len(pairs) + 1)))
        assert np.isclose(column["stutter"][i], np.log((sum(a == b for a, b in pairs) + 0.5) / (len(words) + 1)))
        assert np.isclose(column["bars"][i], np.log((t.count("|") + 0.5) / (len(words) + 1)))
        assert np.isclose(column["non_ascii"][i], np.log((sum(b > 127 for b in t.encode()) + 0.5) / (len(t.encode()) + 1)))
    # A text has the same statistics alone and among others.
    assert np.allclose(got[8:9], statistics(texts[8:9]))


def test_discriminant_matches_the_densities(spark):
    rng = np.random.default_rng(0)
    d = len(quality_qda.FEATURES)
    x = np.concatenate([rng.normal(0, 1, (80, d)), rng.normal(1, 2, (120, d))])
    y = np.array([0] * 80 + [1] * 120)
    df = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, y, strict=True)], "x array<double>, y int").repartition(3)
    model = quality_qda.fit(df, 0.1, 0.2, 0.05)
    pooled = sum(np.cov(x[y == c].T, bias=True) * (y == c).mean() for c in (0, 1))
    log_density = []
    for c in (0, 1):
        s = 0.9 * np.cov(x[y == c].T, bias=True) + 0.1 * pooled
        s = 0.8 * s + 0.2 * np.diag(np.diag(s)) + 0.05 * np.eye(d)
        z = x - x[y == c].mean(0)
        log_density.append(-0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(s), z) - 0.5 * np.linalg.slogdet(s)[1] + np.log((y == c).mean()))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(log_density[0] - log_density[1])))


def confusion(rows, column, spark):
    truth = {r.doc_id: r[column] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    return Counter((truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth)


def test_quality_on_held_out_rows(spark):
    docs, known = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_qda.op1_query(docs, known).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    n = confusion(rows, "quality", spark)
    assert (n[1, 1] + n[0, 0]) / sum(n.values()) >= 0.97


def test_toxicity_on_held_out_rows(spark):
    docs, known = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.op6_query(docs, known).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    n = confusion(rows, "toxic", spark)
    assert n[0, 1] <= 2 and n[1, 1] >= 0.6 * (n[1, 1] + n[1, 0])


@pytest.mark.parametrize("query", [quality_qda.op1_query, toxicity.op6_query])
def test_awkward_rows(spark, query):
    docs = awkward_docs(spark)
    known = labels(spark, [(i, i % 2, i % 2) for i in range(19)] + [(None, 1, 1), (5, None, None), (6, 7, 7), (9, 1, 0), (9, 0, 1)])
    rows = query(docs, known).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(not r.held_out for r in rows if r.doc_id is None)
    for known in (labels(spark), labels(spark, [(1, 1, 0)])):
        assert {r.score for r in query(docs, known).select("score").collect()} <= {0.0, 0.5, 1.0} | {r.score for r in query(docs, known).limit(1).collect()}
    assert query(empty_docs(spark), known).collect() == []


def test_filters_keep_columns_and_follow_the_query(spark):
    docs, known = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    for keep, query, wanted in ((quality_qda.keep_good, quality_qda.op1_query, 1), (toxicity.keep_clean, toxicity.op6_query, 0)):
        kept = keep(docs, known)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in query(docs, known).collect() if r.predicted == wanted)


def test_label_model_and_linear_fit():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.15
    strong = (rng.random((4000, 6)) < np.where(truth[:, None], 0.5, 0.001)).astype(float)     # lexicon voters: silent on clean rows
    copies = np.repeat(strong[:, :1], 5, axis=1)                     # voters that only repeat another one
    noise = (rng.random((4000, 4)) < 0.05).astype(float)
    noisy = np.where(rng.random(4000) < 0.05, ~truth, truth).astype(int)
    p = toxicity.label_model(np.column_stack([strong, copies, noise]), noisy)
    assert ((p > 0.5) == truth).mean() > 0.98 > (noisy == truth).mean()
    hits = [tuple(np.flatnonzero(r)) for r in strong]
    w, bias = toxicity.fit_linear(hits, truth.astype(float), 6)
    assert (w > 1).all() and bias < -1


def test_lexicon_hits():
    lexicon = toxicity.Lexicon(["idio*", "idiot", "kys"])
    assert lexicon.hits("What an IDIOT you are") == [0, 1]
    assert lexicon.hits("idiotic") == [0] and lexicon.hits("kys now") == [2] and lexicon.hits(None) == []
    assert lexicon.hits("Stop!!! " + SENTENCE) == [3]


def test_all_terms_stay_features(spark):
    """More first letters than lexicon voters: every term that passes the tests is a feature, and its documents are found."""
    import itertools
    heads = ["".join(p) for p in itertools.islice(itertools.product("bcdfg", "aeiou", "lmnr", "sty"), 150)]
    rows, labelled = [], []
    for i in range(18000):
        toxic = i % 10 == 0
        rows.append((i, f"filler words here {i} " + (heads[(i // 10) % 150] if toxic else "calm")))
        labelled.append((i, None, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    import zlib
    from collections import Counter
    seen = Counter(heads[(i // 10) % 150] for i in range(0, 18000, 10) if zlib.crc32(str(i).encode()) % 3 != 1)
    common = {h for h in heads if seen[h] >= 7}         # enough for the likelihood ratio
    assert len(common) > 1.5 * toxicity.LEXICON_VOTERS and common <= set(model.lexicon.terms)
    assert model.lexicon.voter_of().max() < toxicity.LEXICON_VOTERS + len(toxicity.PATTERNS)
    scores = [r for r in toxicity.op6_query(docs, labels).collect() if r.held_out]
    assert not any(r.score >= toxicity.THRESHOLD for r in scores if r.doc_id % 10) and len(scores) > 500
    assert all(r.score >= toxicity.THRESHOLD for r in scores if r.doc_id % 10 == 0 and heads[(r.doc_id // 10) % 150] in common)


def test_scores_equal_brute_force(spark):
    """The model refitted by plain loops: terms by their counts, EM as given, the regression by dense Newton steps."""
    import numpy as np
    rnd = np.random.default_rng(3)
    words = ["alpha", "beta", "gamma", "delta", "idiot", "moronic", "stupidly", "calm"]
    rows = [(i, " ".join(rnd.choice(words[4:7] if i % 4 == 0 else words[:4] + words[7:], 5)) + ("!!!" if i % 7 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, None, int(i % 4 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    import zlib
    train = {t: int(i % 4 == 0) for i, t in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    texts, y = list(train), np.array(list(train.values()))
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    found = []
    bags = [toxicity.words_of(t) | toxicity.stems_of(toxicity.words_of(t)) for t in texts]
    for term in sorted(set().union(*bags)):
        k1, k0 = (sum(term in b for b, l in zip(bags, y, strict=True) if l == c) for c in (1, 0))
        if k1 >= 4 and np.log((k1 + .5) / (n1 + 1)) - np.log((k0 + .5) / (n0 + 1)) >= 2.5 and toxicity.likelihood_ratio(k1, n1, k0, n0) >= 24:
            found.append(term)
    lexicon = toxicity.Lexicon(found)
    hits = [lexicon.hits(t) for t in texts]
    voter = lexicon.voter_of()
    votes = np.zeros((len(texts), toxicity.LEXICON_VOTERS + len(toxicity.PATTERNS)))
    for i, h in enumerate(hits):
        votes[i, voter[h]] = 1
    order = sorted(range(len(texts)), key=lambda i: texts[i])
    target = toxicity.label_model(votes[order], y[order])
    x = np.zeros((len(texts), lexicon.size + 1))
    for r, i in enumerate(order):
        x[r, hits[i]] = 1
    x[:, -1] = 1
    w = np.zeros(lexicon.size + 1)
    w[-1] = np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3))
    penalty = np.append(np.full(lexicon.size, 0.1), 1e-3)
    for _ in range(15):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = penalty * np.append(w[:-1], 0) + x.T @ (p - target)
        step = np.linalg.solve(np.diag(penalty) + x.T @ (x * np.maximum(p * (1 - p), 1e-4)[:, None]), grad)
        w -= step * min(1.0, 4.0 / (np.abs(step).max() + 1e-9))
    for r in toxicity.op6_query(docs, labels).collect():
        z = w[-1] + w[lexicon.hits(rows[r.doc_id][1])].sum()
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-6
