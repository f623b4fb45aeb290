"""Byte-level BPE by corpus-level merge replay, and decoding.

The distinct pre-tokens of the corpus are brought together by a shuffle. A task lays its pre-tokens out as one
row of byte symbols and keeps an inverted index from merge rank to the positions of the pairs with that
rank. Ranks are applied in order; a merge changes only its two symbols, looks up the pairs with the two
neighbours and files them under their ranks. Each document is then its pre-tokens' ids in order.

A rank file can hold pairs that rank below a symbol they are made of; when such a pair appears, the rest of the
running rank waits for it, so that every word sees its merges in rank order, leftmost first.

Defined results: a null or empty text has no tokens, and both digests are those of no bytes. Special strings
inside texts are ordinary text. Repeated rows, equal and null ids give one row each. An empty table gives no rows.
Other columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretokens import encode_once, make_blocks, resolve

RANKS = "byte_bpe_50k.tiktoken"
_SHIFT = 24


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> list[bytes]:
    ranks = load_ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


@lru_cache(maxsize=2)
def _merges(path: str) -> dict[int, int]:
    """(left id << 24 | right id) -> rank of the pair, which is also the merged id."""
    ranks = load_ranks(path)
    return {ranks[t[:k]] << _SHIFT | ranks[t[k:]]: r for t, r in ranks.items() for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks}


@lru_cache(maxsize=2)
def _pattern(pattern: str):
    import regex
    return regex.compile(pattern)


@lru_cache(maxsize=1)
def _late_letters():
    """Matches the characters that the regex module takes for letters or numbers and the tiktoken library, with
    its older Unicode tables, does not; None if there are none."""
    import regex
    import tiktoken

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    late: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}"):
        library = tiktoken.Encoding("kind", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        known = library.decode_bytes(library.encode_ordinary(every)).decode()
        late |= set(regex.findall(kind, every)) - set(known)
    return regex.compile("[" + "".join(map(regex.escape, sorted(late))) + "]") if late else None


def split(text: str, pattern: str) -> list[str]:
    """Matches of the pattern, as the tiktoken library would find them."""
    late = None if text.isascii() or max(text) < "\u0500" else _late_letters()
    if late is None or not late.search(text):
        return _pattern(pattern).findall(text)
    found = []              # matched with a private-use character in their place, cut from the text itself
    for m in _pattern(pattern).finditer(late.sub("\ue000", text)):
        found.append(text[m.start():m.end()])
    return found


def replay(words: list[bytes], path: str) -> list[list[int]]:
    """Ids of each word, by applying all merges to all words in rank order."""
    if not words:
        return []
    ranks, merges = load_ranks(path), _merges(path)
    byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = byte_id[np.frombuffer(b"".join(words), np.uint8)]
    n = len(flat)
    ends = np.cumsum(lengths)
    following, preceding = np.arange(1, n + 1), np.arange(-1, n - 1)
    following[ends[lengths > 0] - 1] = -1
    preceding[(ends - lengths)[lengths > 0]] = -1
    symbol, after, before = flat.tolist(), following.tolist(), preceding.tolist()

    index: dict[int, list[int]] = {}
    for i, j in enumerate(after):
        if j >= 0:
            r = merges.get(symbol[i] << _SHIFT | symbol[j])
            if r is not None:
                index.setdefault(r, []).append(i)
    heap = sorted(index)
    while heap:
        rank = heappop(heap)
        places = index.pop(rank, None)
        if places is None:
            continue
        places.sort()
        for done, i in enumerate(places, start=1):
            j = after[i]
            if j < 0 or symbol[i] < 0 or merges.get(symbol[i] << _SHIFT | symbol[j]) != rank:
                continue            # an earlier merge has taken one of the two
            symbol[i], symbol[j] = rank, -1
            k = after[i] = after[j]
            h = before[i]
            lowest = rank + 1
            if k >= 0:
                before[k] = i
                r = merges.get(rank << _SHIFT | symbol[k])
                if r is not None:
                    if r not in index:
                        index[r] = [i]
                        heappush(heap, r)
                    else:
                        index[r].append(i)
                    lowest = r
            if h >= 0:
                r = merges.get(symbol[h] << _SHIFT | rank)
                if r is not None:
                    if r not in index:
                        index[r] = [h]
                        heappush(heap, r)
                    else:
                        index[r].append(h)
                    if r < lowest:
                        lowest = r
            if lowest <= rank:      # this pair goes first: file the rest of the running rank again
                if rank not in index:
                    heappush(heap, rank)
                index.setdefault(rank, []).extend(places[done:])
                break
    out = np.array(symbol, np.int64)
    alive = out >= 0
    kept = np.concatenate([[0], np.cumsum(alive)])
    ids = out[alive].tolist()
    return [ids[kept[e - m]:kept[e]] for e, m in zip(ends.tolist(), lengths.tolist(), strict=True)]


def decode(ids: list[int], path: str) -> bytes:
    vocabulary = _vocabulary(path)
    return b"".join([vocabulary[i] for i in ids])


def _documents(docs: DataFrame, id_col: str, text_col: str, path: str, pattern: str, finish_values, schema: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    blocks = make_blocks(rows, lambda text: split(text, pattern), bags=False)

    def finish(block: dict, starts: np.ndarray, values: np.ndarray) -> dict:
        ends = block["ends"]
        numbers = [block["numbers"][a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return {"doc_id": block["ids"], **finish_values(numbers, starts, values)}

    encoded = encode_once(blocks, lambda: lambda tokens: replay([t.encode() for t in tokens], path))
    return resolve(blocks, encoded, finish, f"doc_id {dict(rows.dtypes)['doc_id']}, {schema}")


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                     pattern: str | None = None) -> DataFrame:
    """doc_id, ids of each document. ``path``: a rank file that all executors can read."""
    def ids(numbers, starts, values) -> dict:
        place = [np.concatenate([np.arange(starts[k], starts[k + 1]) for k in d]) if len(d) else np.zeros(0, np.int64) for d in numbers]
        return {"ids": pa.array([values[p] for p in place], pa.list_(pa.int32()))}

    return _documents(docs, id_col, text_col, path or ranks_path(), pattern or default_pattern(), ids, "ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, bytes of each row of encode_documents."""
    path = path or ranks_path()

    def run(batches):
        for batch in batches:
            data = [decode(ids or [], path) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, bytes binary")


def digest_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                     pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes decoded from them."""
    path = path or ranks_path()

    def digests(numbers, starts, values) -> dict:
        count = np.diff(starts)
        bounds = starts.tolist()
        as_text, as_bytes = [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            ids = values[a:b].tolist()
            as_text.append(" ".join(map(str, ids)))
            as_bytes.append(decode(ids, path))
        totals, ids_digests, byte_digests = [], [], []
        for d in numbers:
            words = d.tolist()          # one document's at a time: lists of all would take most of a worker's memory
            totals.append(int(count[d].sum()))
            ids_digests.append(hashlib.sha256(" ".join([as_text[k] for k in words]).encode()).hexdigest())
            byte_digests.append(hashlib.sha256(b"".join([as_bytes[k] for k in words])).hexdigest())
        return {"n_tokens": pa.array(totals, pa.int64()), "ids_sha256": ids_digests, "decoded_sha256": byte_digests}

    return _documents(docs, id_col, text_col, path, pattern or default_pattern(), digests,
                      "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_query(docs: DataFrame) -> DataFrame:
    return digest_documents(docs)
