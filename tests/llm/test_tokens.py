"""Token counts and byte-level BPE against the libraries."""

import hashlib
import random

import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quantleaf.llm import byte_bpe, pretokens, token_counts

from .helpers import awkward_docs, documents, empty_docs

PATH = byte_bpe.ranks_path()
PATTERN = byte_bpe.default_pattern()
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.load_ranks(PATH), special_tokens={})
PIECES = sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())
TEXT = st.text(alphabet=st.one_of(st.sampled_from(" \t\n▁aething'sLL1½é中\x1c\x85\xa0"), st.characters(exclude_categories=["Cs"])), max_size=80)


def ids_of(text):
    words = byte_bpe.split(text, PATTERN)
    return [i for ids in byte_bpe.replay([w.encode() for w in words], PATH) for i in ids]


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_replay_equals_the_library(text):
    ids = ids_of(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert byte_bpe.decode(ids, PATH) == text.encode()


def test_replay_of_runs_and_many_words_at_once():
    rnd = random.Random(3)
    words = [c * k for c in ("a", "=", " ", "ab", "the", "\n") for k in (1, 2, 3, 7, 64, 501)]
    words += ["".join(rnd.choice("etaoinsh") for _ in range(rnd.randint(1, 40))) for _ in range(2000)]
    got = byte_bpe.replay([w.encode() for w in words], PATH)
    assert got == [LIBRARY._encode_single_piece(w) for w in words]
    assert byte_bpe.replay([], PATH) == []


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_piece_counts_equal_the_library(text):
    tokens = token_counts.split(text)
    assert sum(n for [n] in token_counts.count_pieces(tokens, token_counts.model_path())) == len(PIECES.encode(text))


def check_counts(df, docs):
    want = sorted((str(r.doc_id), len((r.text or "").encode()), len(PIECES.encode(r.text or ""))) for r in docs.select("doc_id", "text").collect())
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in df.collect()) == want


def test_token_counts(spark):
    for docs in (awkward_docs(spark), documents(spark)):
        check_counts(token_counts.op2_query(docs), docs)
    assert token_counts.op2_query(empty_docs(spark)).collect() == []
    assert [r.over_limit for r in token_counts.op2_query(spark.createDataFrame([(1, "a " * 5000)], "doc_id long, text string")).collect()] == [True]


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(pretokens, "ENCODE_AT_ONCE", 50)
    docs = documents(spark).repartition(3)
    blocks = pretokens.make_blocks(docs, token_counts.split, bags=True, block_chars=20_000)
    assert blocks.count() > 10
    encoded = pretokens.encode_once(blocks, lambda: lambda tokens: [[len(t)] for t in tokens])

    def finish(block, starts, values):
        import numpy as np
        lengths = values[block["numbers"]].astype(np.int64) * block["times"]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return {"doc_id": block["ids"], "n": total[block["ends"][1:]] - total[block["ends"][:-1]]}

    got = {r.doc_id: r.n for r in pretokens.resolve(blocks, encoded, finish, "doc_id long, n long").collect()}
    assert got == {r.doc_id: len(r.text) + 1 for r in docs.collect()}


def test_digests_and_round_trip(spark):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for docs in (awkward_docs(spark), documents(spark)):
        want = []
        for r in docs.select("doc_id", "text").collect():
            ids = LIBRARY.encode_ordinary(r.text or "")
            want.append((str(r.doc_id), len(ids), sha(" ".join(map(str, ids)).encode()), sha((r.text or "").encode())))
        got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.op9_query(docs).collect()]
        assert sorted(got) == sorted(want)
    assert byte_bpe.op9_query(empty_docs(spark)).collect() == []
    docs = awkward_docs(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    encoded = byte_bpe.encode_documents(docs)
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    assert {r.doc_id: r.ids for r in encoded.collect()} == {k: LIBRARY.encode_ordinary(t) for k, t in texts.items()}
    assert {r.doc_id: bytes(r.bytes).decode() for r in byte_bpe.decode_documents(encoded).collect()} == texts
