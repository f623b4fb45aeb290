"""Line rules and source mixing against brute force and their SQL."""

import math
import os
from collections import Counter, defaultdict

import duckdb
import pytest

from quantleaf.llm import catalog, line_rules, mixing

from .helpers import SF, WORD, awkward_docs, documents, empty_docs


def repeat_words(words):
    seen, covered = defaultdict(list), set()
    for i in range(len(words) - 7):
        seen[tuple(words[i:i + 8])].append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(k for p in places for k in range(p, p + 8))
    return len(covered)


def test_line_rules_counts_match_brute_force(spark):
    docs = awkward_docs(spark).unionByName(documents(spark), allowMissingColumns=True)
    texts = Counter((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got, want = Counter(), Counter()
    for (doc_id, text), n in texts.items():
        words = WORD.findall(text or "")
        lines = [s for s in (text or "").split("\n") if WORD.search(s)]
        want[(doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
              repeat_words(words))] += n
    for r in line_rules.op7_query(docs).collect():
        got[(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)] += 1
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
        assert r.kept_words <= r.n_words
    assert got == want


def test_line_rules_verdict(spark):
    clean = "A plain sentence with a few words stands here and ends well. It has a second one, which is longer than that. "
    bars = " | ".join("home about contact news sport".split() * 3)
    rows = [(1, clean * 1 + "\n" + "Another line of plain prose follows here, and it ends as well."), (2, clean + "\n" + "\n".join(
        f"{bars} {i}" for i in range(9))), (3, clean + "\nWe use cookies. Click here."), (4, "WOW!! " * 10 + "so!! " * 15)]
    got = {r.doc_id: r for r in line_rules.clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].kept for i in (1, 2, 3, 4)] == [True, False, True, False]
    assert got[3].clean_text == clean
    assert got[2].clean_text == clean


def test_native_queries_run_no_python(spark):
    for df in (line_rules.op7_query(documents(spark)), mixing.op8_query(documents(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_empty_tables(spark):
    assert line_rules.op7_query(empty_docs(spark)).collect() == []
    assert mixing.op8_query(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("name", ["op7_line_rules", "op8_mix_sources"])
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    want = con.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    df = catalog.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    norm = lambda v: round(v, 6) if isinstance(v, float) else v
    assert Counter(tuple(norm(r[c]) for c in columns) for r in df.collect()) == Counter(tuple(map(norm, r)) for r in want.fetchall())


def water_fill(sizes, weights, times=3):
    """Share out by weight, cap, share out the excess again, until nothing is above its cap."""
    total, capped = sum(sizes.values()), {}
    while True:
        free = {s: w for s, w in weights.items() if s not in capped}
        left = total - sum(capped.values())
        share = {s: left * w / sum(free.values()) for s, w in free.items()} if free else {}
        over = {s: times * sizes[s] for s in share if share[s] > times * sizes[s] + 1e-9}
        if not over:
            return capped | share
        capped |= over


def test_mixing_matches_brute_force(spark):
    docs = awkward_docs(spark)
    rows = mixing.op8_query(docs).collect()
    assert len(rows) == docs.count()
    sizes, by = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r.source] += r.size
        by[r.source].append(r)
    weights = {s: k % 3 + 1 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target = water_fill(sizes, weights)
    for s, own in by.items():
        assert all(math.isclose(r.target, target[s], rel_tol=1e-9, abs_tol=1e-6) and r.source_size == sizes[s] for r in own)
        taken = sum(r.taken for r in own)
        assert abs(taken - target[s]) <= max(r.size for r in own) / 2 + 1e-6
        epochs = target[s] // sizes[s] if sizes[s] else 0
        assert all(r.taken in (epochs * r.size, (epochs + 1) * r.size) and r.taken <= 3 * r.size for r in own)


def test_mixing_reruns_agree_and_small_ranges_give_the_same(spark, monkeypatch):
    docs = documents(spark)
    first = sorted(map(tuple, mixing.op8_query(docs).collect()))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    assert sorted(map(tuple, mixing.op8_query(docs.repartition(7)).collect())) == first


def test_mixing_prefers_quality(spark):
    good = [(i, "plain words in a row " * 5, "a") for i in range(300)]
    bad = [(1000 + i, "noise ## $$ ** && %% <> " * 4, "a") for i in range(300)]
    other = [(5000 + i, "words " * 40, "b") for i in range(600)]
    docs = spark.createDataFrame(good + bad + other, "doc_id long, text string, source string")
    rows = mixing.mix_sources(docs, weights=(1, 9)).collect()       # source a gives about a quarter of its words
    extra = lambda lo, hi: sum(r.copies for r in rows if lo <= r.doc_id < hi)
    assert extra(0, 1000) > 2 * extra(1000, 2000)


def test_mixed_documents_keep_all_columns(spark):
    docs = awkward_docs(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = {}
    for r in mixing.op8_query(docs).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    got = Counter(r.doc_id for r in mixed.collect())
    assert got == Counter({k: v for k, v in copies.items() if v})


def test_the_cut_may_fall_among_equal_rows(spark):
    docs = spark.createDataFrame([(None, "five words are in here", "a")] * 40 + [(7, "just three words", "a")] * 30 +
                                 [(i, "some other words " * 9, "b") for i in range(60)], "doc_id long, text string, source string")
    rows = mixing.mix_sources(docs, weights=(1, 3)).collect()
    taken = {s: sum(r.taken for r in rows if r.source == s) for s in "ab"}
    assert len(rows) == 130 and all(abs(taken[r.source] - r.target) <= r.size for r in rows)
    assert len({r.copies for r in rows if r.source == "a" and r.doc_id is None} | {r.copies for r in rows if r.doc_id == 7}) == 2
    assert Counter(r.doc_id for r in mixing.mixed_documents(docs, weights=(1, 3)).collect())[7] == sum(r.copies for r in rows if r.doc_id == 7)


def test_mixing_moves_no_texts(spark):
    plan = mixing.mixed_documents(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan and "ArrowEval" not in plan
