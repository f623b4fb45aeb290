"""The pipeline against a replay of its stages by brute force."""

import hashlib
from collections import Counter

import tiktoken

import corpus_pipeline
from quantleaf.llm import byte_bpe, mixing, quality_qda, toxicity

from .helpers import SF, documents, empty_docs
from .test_neardups import brute_force


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "mix", "encode"]


def test_pipeline_replayed(spark):
    docs = documents(spark)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in quality_qda.op1_query(docs, labels).collect() if r.predicted}
    docs = docs.where(docs["doc_id"].isin(sorted(good)))
    clean = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.op6_query(docs, labels).collect() if r.predicted}
    clean = {i: t for i, t in clean.items() if i not in toxic}
    one = {i for i, (_, component) in brute_force(clean).items() if i == component}
    copies = {r.doc_id: r.copies for r in mixing.op8_query(docs.where(docs["doc_id"].isin(sorted(one)))).collect()}
    library = tiktoken.Encoding("own", pat_str=byte_bpe.default_pattern(), mergeable_ranks=byte_bpe.load_ranks(byte_bpe.ranks_path()), special_tokens={})
    want = Counter()
    for i in one:
        ids = library.encode_ordinary(clean[i])
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(clean[i].encode()).hexdigest()] += copies[i]
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == +want and 0 < len(got) < len(clean) < 200


def test_stages_take_an_empty_table(spark):
    docs = empty_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.collect() == []
        if name != "encode":
            assert out.columns == docs.columns
