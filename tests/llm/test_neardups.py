"""Near-duplicates against brute force."""

import random
from collections import defaultdict

import numpy as np

from pyspark.sql import functions as F

from quantleaf.llm import neardups

from .helpers import WORD, awkward_docs, documents, empty_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_force(texts):
    """doc_id -> (n_shingles, component)."""
    sets, parent = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(n=150, seed=2):
    """A hot group: near copies with similarities on both sides of the threshold, exact copies, and strangers."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghijklm") for _ in range(6))
    base = [word() for _ in range(60)]
    texts = {}
    for i in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(60)] = word()
        texts[i] = " ".join(w) if i % 3 else " ".join(base)
    for i in range(n, n + 40):
        texts[i] = " ".join(base[:25] + [word() for _ in range(30)])
    return texts


def check(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_force(texts)
    for r in neardups.op10_query(df).collect():
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r
        assert r.kept == (r.doc_id == r.component_id)


def test_given_documents(spark):
    check(spark, {r.doc_id: r.text for r in documents(spark).collect()})


def test_hot_group(spark):
    check(spark, near_copies())


def test_chunks_of_a_large_bucket(spark, monkeypatch):
    propose, crossing = neardups.propose, neardups.crossing_links
    monkeypatch.setattr(neardups, "propose", lambda members: propose(members, chunk=16))
    monkeypatch.setattr(neardups, "crossing_links", lambda members, texts: crossing(members, texts, chunk=16))
    check(spark, near_copies(seed=4))


def test_rounds_of_chunks(spark, monkeypatch):
    monkeypatch.setattr(neardups, "CHUNK", 16)
    check(spark, near_copies(seed=5))
    monkeypatch.setattr(neardups, "ROUNDS", 1)
    check(spark, near_copies(seed=7))


def test_hot_bucket_is_not_copied_to_all_chunk_pairs(spark):
    """20 chunks in one bucket: one component and three other rows make about n rows, and each pair of components meets once."""
    n, chunk = 2000, 100
    rows = [(1, n + 3, i, 0 if i < n else i) for i in range(n + 3)] + [(2, 50, i, i % 5) for i in range(50)]
    members = spark.createDataFrame(rows, "bucket long, n long, rep long, component long")
    made = neardups.cells(members, chunk).collect()
    big = [r for r in made if r.bucket == 1]
    assert len(big) <= n + 3 * (n // chunk + 2)
    met = {}
    for r in big:
        met.setdefault(r.cell, []).append(r)
    pairs = [(a.rep, b.rep) for cell in met.values() for k, a in enumerate(cell) for b in cell[k + 1:]
             if a.component != b.component and (not a.mixed or a.part != b.part)]
    assert len(pairs) == len({tuple(sorted(p)) for p in pairs}) == 3 * n + 3
    assert len([r for r in made if r.bucket == 2]) == 50
    dealt = neardups.chunks(members.withColumn("seed", F.lit(0)), chunk)
    assert dealt.count() == len(rows) and max(r["count"] for r in dealt.groupBy("bucket", "cell").count().collect()) < 2 * chunk


def test_small_tables_are_not_spread_over_all_partitions(spark):
    """200 rows, with 64 shuffle partitions that are not merged: most stages have far fewer tasks."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    sc, texts = spark.sparkContext, near_copies()
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        sc.setJobGroup("neardups-tasks", "tasks of a small run")
        check(spark, texts)
        stages = {s for job in sc.statusTracker().getJobIdsForGroup("neardups-tasks") for s in sc.statusTracker().getJobInfo(job).stageIds}
        done = [info.numCompletedTasks for s in stages if (info := sc.statusTracker().getStageInfo(s))]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(done) < 2000, sum(done)


def test_stars(spark):
    def stars(*edges):
        return neardups._stars(spark.createDataFrame(list(edges), "u long, v long"), len(edges))

    assert stars((5, 1), (3, 1), (4, 2)) and stars()
    assert not stars((5, 1), (5, 2)) and not stars((5, 3), (3, 1))


def test_links_that_no_proposed_pair_finds(spark, monkeypatch):
    """Without any proposed pair, the second pass alone finds all links."""
    monkeypatch.setattr(neardups, "propose", lambda members: members.sparkSession.createDataFrame([], "a long, b long"))
    check(spark, near_copies(n=80, seed=6))


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    got = neardups.op10_query(docs).collect()
    assert len(got) == docs.count()
    texts = docs.select("doc_id", "text").collect()
    assert sorted(r.n_shingles for r in got) == sorted(len(shingles(t.text)) for t in texts)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        elif not r.n_shingles:
            assert r.component_id == r.doc_id and r.kept
    assert {r.component_id for r in got if r.doc_id in (9, 10, 11) and r.n_shingles > 10} == {9}
    assert neardups.op10_query(empty_docs(spark)).collect() == []


def test_keep_one(spark):
    docs = awkward_docs(spark)
    kept = neardups.keep_one(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 9 in ids and 10 not in ids and 11 not in ids and {0, 1, 2, 3} <= ids and None in ids


def test_keep_one_keeps_one_row(spark):
    long = [" ".join(f"w{k}-{i}" for i in range(60)) for k in range(4)]
    near = long[0] + " and more"
    rows = [(5, long[0])] * 30 + [(7, near), (7, long[1]), (7, long[1])] + [(None, long[2])] * 9 + [(None, long[0]), (None, None), (None, None), (None, "")]
    rows += [(8, None), (8, None), (9, ""), (10, ""), (11, long[3]), (12, long[3] + " end"), (13, near)]
    docs = spark.createDataFrame([(i, t, f"s{k}") for k, (i, t) in enumerate(rows)], "doc_id long, text string, source string").repartition(3)
    kept = neardups.keep_one(docs)
    assert kept.columns == docs.columns
    want = [(5, long[0]), (7, long[1]), (None, long[2]), (None, None), (None, ""), (8, None), (9, ""), (10, ""), (11, long[3])]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert neardups.keep_one(awkward_docs(spark)).count() == 20
    assert neardups.keep_one(empty_docs(spark)).collect() == []


def test_sketch_fills_every_bin_and_estimates():
    rnd = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.75, 0.9):
        common = rnd.integers(0, 1 << 63, int(2000 * share), dtype=np.uint64)
        a = np.concatenate([common, rnd.integers(0, 1 << 63, (2000 - len(common)) // 2, dtype=np.uint64)])
        b = np.concatenate([common, rnd.integers(0, 1 << 63, (2000 - len(common)) // 2, dtype=np.uint64)])
        s = neardups.sketch([np.unique(a), np.unique(b), np.unique(a)[:1]])
        assert s.shape == (3, neardups.T) and (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
        assert abs((s[0] == s[1]).mean() - len(common) / (len(a) + len(b) - len(common))) < 0.13


def test_components_of_random_graphs(spark):
    rnd = random.Random(9)
    for n, m in ((40, 25), (200, 180)):
        edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(300, 360)]
        parent = defaultdict(lambda: None)

        def root(x):
            while parent[x] is not None:
                x = parent[x]
            return x

        for a, b in edges:
            a, b = sorted((root(a), root(b)))
            if a != b:
                parent[b] = a
        got = {r.node: r.component for r in neardups.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        nodes = {x for e in edges if e[0] != e[1] for x in e}
        assert all(got.get(x, x) == root(x) for x in nodes)


def test_tables_of_representatives_hold_each_once(spark, monkeypatch):
    """Until they go out to their buckets, near copies are one row each, not one for each bucket and deal."""
    real, rows = neardups.materialise, {}

    def stored(df, name, *more):
        out = real(df, name, *more)
        rows[name] = max(rows.get(name, 0), out.count())
        return out

    monkeypatch.setattr(neardups, "materialise", stored)
    monkeypatch.setattr(neardups, "CHUNK", 16)
    texts = near_copies(seed=8)
    check(spark, texts)
    assert rows["sketches"] > 16
    assert all(rows.get(name, 0) <= len(texts) for name in ("members", "sketches", "proposing", "texts")), rows
