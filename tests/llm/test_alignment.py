"""Cross-tokenizer alignment against pairwise comparison of all tokens."""

import hashlib
from collections import Counter, defaultdict

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quantleaf.llm import alignment

from .helpers import awkward_docs, documents, empty_docs

A = Tokenizer.from_file(alignment.model_path(alignment.MODEL_A))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=alignment.model_path(alignment.MODEL_B))
SIDES = alignment.byte_level_side(alignment.model_path(alignment.MODEL_A)), alignment.piece_side(alignment.model_path(alignment.MODEL_B))
TEXT = st.text(alphabet=st.one_of(st.sampled_from(" \t\n▁aething'sLL1½é中\x1c\x85\xa0☃<|>"), st.characters(exclude_categories=["Cs"])), max_size=60)
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spans(pieces):
    out, at = [], 0
    for i, b in pieces:
        out.append((i, at, at + len(b)))
        at += len(b)
    return out


def tokens(text):
    if not text:
        return [], []
    whole = b" " + text.encode()
    a = [(i, SIDES[0].bytes[i]) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, SIDES[1].bytes[i]) for i in B.encode(text)]
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return [], []
    return spans(a), spans(b)


def links(a, b):
    return [(i, j) for i, s, e in a for j, s2, e2 in b if s < e2 and s2 < e]


def written(a, b):
    cuts = sorted({e for *_, e in a} & {e for *_, e in b})
    out, start = [], 0
    for cut in cuts:
        out.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= cut) for side in (a, b)))
        start = cut
    return ";".join(out), len(cuts)


def brute_force(texts):
    sides = [tokens(t) for t in texts]
    found = [links(a, b) for a, b in sides]
    count = Counter(p for f in found for p in set(f))
    best = defaultdict(int)
    for (i, _), c in count.items():
        best[i] = max(best[i], c)
    out = []
    for (a, b), f in zip(sides, found, strict=True):
        text, n = written(a, b)
        out.append((len(a), len(b), n, len(f), sum(count[p] == best[p[0]] for p in f), sum(count[p] for p in f),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_align_equals_all_pairs(texts):
    got = alignment.align(texts, alignment.Known(SIDES, limit=20))
    for i, t in enumerate(texts):
        a, b = tokens(t)
        text, n = written(a, b)
        assert (got["n_a"][i], got["n_b"][i], got["n_groups"][i], got["n_links"][i], got["groups"][i]) == (len(a), len(b), n, len(links(a, b)), text)
    at = 0
    for t, k in zip(texts, got["pairs"], strict=True):
        pairs = {(p // alignment.SIDE, p % alignment.SIDE): c for p, c in zip(got["pair"][at:at + k], got["times"][at:at + k], strict=True)}
        assert pairs == Counter(links(*tokens(t)))
        at += k


def check(df, docs):
    rows = [r for r in docs.select("doc_id", "text").collect()]
    want = sorted((str(r.doc_id), *w) for r, w in zip(rows, brute_force([r.text for r in rows]), strict=True))
    assert sorted((str(r.doc_id), *[r[c] for c in COLUMNS]) for r in df.collect()) == want


def test_documents(spark):
    small = documents(spark).where("n_chars < 2500")         # all pairs of tokens are slow for long texts
    check(alignment.op11_query(small), small)


def test_awkward_rows(spark):
    docs = awkward_docs(spark).where("text IS NULL OR length(text) < 30000")
    check(alignment.op11_query(docs), docs)
    assert alignment.op11_query(empty_docs(spark)).collect() == []
    long = [r for r in alignment.op11_query(awkward_docs(spark).where("length(text) > 30000")).collect()]
    assert len(long) == 1 and long[0].n_links >= max(long[0].n_a, long[0].n_b)


def test_small_blocks_and_plain_groups(spark, monkeypatch):
    docs = documents(spark).where("n_chars < 1500").select("doc_id", "text").repartition(3)
    make = alignment.make_blocks
    monkeypatch.setattr(alignment, "make_blocks", lambda *a: make(*a, block_links=300))
    check(alignment.op11_query(docs), docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in alignment.align_documents(docs).collect():
        assert r.groups == written(*tokens(texts[r.doc_id]))[0]


def test_new_pieces_are_encoded_many_at_a_time():
    """Plain new pieces go to the tokenizers in runs, and each gets the ids that it has by itself; odd pieces come back or not as before."""
    given = []

    def counting(side):
        def encode_pieces(pieces):
            given.append(len(pieces))
            return side.encode_pieces(pieces)
        return alignment.Side(side.encode, encode_pieces, side.bytes)

    pieces = [f" word{i}".encode() for i in range(1000)] + ["▁x".encode(), " a▁b".encode(), b"\n\n", b" ", " naïve".encode(), b"\n12.", "é".encode(), b" I'll"]
    known = alignment.Known(tuple(map(counting, SIDES)))
    slots = known.slots(pieces)
    assert sum(given) <= 2 * (1000 // alignment.JOINED + 2 * alignment.JOINED)
    for k, side in enumerate(SIDES):
        ids, n = known.take(k, slots)
        alone = side.encode_pieces([p.decode() for p in pieces])
        assert n.tolist() == list(map(len, alone)) and ids.tolist() == [i for x in alone for i in x]
    told = [all(b"".join(side.bytes[i] for i in side.encode_pieces([p.decode()])[0]) == p for side in SIDES) for p in pieces]
    assert known.whole[slots].tolist() == told and not all(told)
