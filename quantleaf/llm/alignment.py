"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and which belong together corpus-wide.

1. A task encodes its documents with both tokenizers, each distinct piece of text once, and places the tokens by byte. For each batch, ``pandas.merge_asof``
   finds for each token start the other side's covering token, in both directions; the union of both
   is the set of overlapping token pairs (links). Offsets where tokens of both sides end cut the tokens into groups.
2. A block is a run of documents of one task, of bounded size, with a dictionary of its distinct id pairs and in how many
   of its documents each is linked. Documents refer to the dictionary by number. Blocks are stored bucketed, so documents never move.
3. The dictionaries' entries meet by pair (one shuffle; a pair occurs once per block, so no key is hot within a partition):
   their sum is the pair's corpus-wide count. The counts go back packed, by block; the highest count of each A id, at most one
   number per entry of A's vocabulary, is known to all.
4. A block's documents add up the counts of their links.

A text is aligned as ``space + text``: the byte-level tokenizer A gets the space, the piece tokenizer B adds it.

Defined results: null and empty texts, and texts whose tokens of either side do not give back the bytes of space + text (such as those
holding the sign that B writes for a space), have no tokens: zeros, no links, an empty groups column. Repeated rows, equal and null ids
give one row each, and each such row counts as a document. An empty table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import buffer_of, materialise, scratch_dir, text_slices
from .pretokens import pack, unpack
from .token_counts import check_model

MODEL_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_LINKS = 8_000_000        # a block ends at this many distinct (document, pair), or with its task
KNOWN = 800_000                # distinct pieces of text whose ids a task remembers
SIDE = 1 << 20                 # a pair of ids as one number: a * SIDE + b
PAIR_BITS = 40
JOINED = 50                    # new pieces encoded as one text


def model_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_of_char() -> dict[str, int]:
    """Byte that a character of a byte-level vocabulary stands for: printable Latin-1 stands for itself, the other
    bytes are written as the characters from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """A tokenizer as a batch encoder, the bytes of its entries, and its ids written with each separator."""

    def __init__(self, encode, encode_pieces, entry_bytes: list[bytes]):
        self.encode, self.encode_pieces, self.bytes = encode, encode_pieces, entry_bytes
        self.length = np.fromiter(map(len, entry_bytes), np.int64, len(entry_bytes))
        self.written = [f"{i}{mark}" for mark in ",|;" for i in range(len(entry_bytes))]


@lru_cache(maxsize=2)
def byte_level_side(path: str) -> Side:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # one thread per task
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    cut = model.get("pre_tokenizer") or {}
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        raise ValueError("not a byte-level tokenizer whose pre-tokens hold white space at their start only")
    added = {t["id"]: t["content"].encode() for t in model.get("added_tokens", [])}
    byte = _byte_of_char()
    vocabulary = {i: t for t, i in tokenizer.get_vocab(with_added_tokens=True).items()}
    entries = [added.get(i) or bytes(byte[c] for c in vocabulary[i]) for i in range(max(vocabulary) + 1)]

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def encode_pieces(pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
    return Side(encode, encode_pieces, entries)


@lru_cache(maxsize=2)
def piece_side(path: str) -> Side:
    import sentencepiece
    p = sentencepiece.SentencePieceProcessor(model_file=path)

    def entry(piece: str) -> bytes:
        found = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode()
    check_model(path)
    # behind a line feed the model puts no space of its own before a piece; the feed and the space before it are two tokens
    return Side(lambda texts: p.encode(texts, num_threads=1), lambda pieces: [ids[2:] for ids in p.encode(["\n" + t for t in pieces], num_threads=1)],
                [entry(p.id_to_piece(i)) for i in range(p.get_piece_size())])


def tokens_of(texts: list[str | None], side: Side, other: Side) -> tuple[list[list[int]], list[list[int]]]:
    """Ids of both sides for each text; none where a text is empty or does not come back from its tokens."""
    filled = [i for i, t in enumerate(texts) if t]
    ids_a, ids_b = [[]] * len(texts), [[]] * len(texts)
    some = [texts[i] for i in filled]
    for i, a, b in zip(filled, side.encode(some), other.encode(some), strict=True):
        whole = b" " + texts[i].encode()
        if b"".join(map(side.bytes.__getitem__, a)) == whole == b"".join(map(other.bytes.__getitem__, b)):
            ids_a[i], ids_b[i] = a, b
    return ids_a, ids_b


def cut_pieces(texts: list[str]) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """Text number and bytes of the pieces of ``space + text``. A piece ends before a space or line feed that follows a
    visible ASCII character: pre-tokens of both sides hold such white space at their start only, so no token crosses that place."""
    raw, offsets = buffer_of(pa.array([" " + t for t in texts], pa.large_string()))
    cut = (raw == 32) | (raw == 10)
    cut[1:] &= (raw[:-1] > 32) & (raw[:-1] < 127)
    cut[offsets[:-1]] = True
    starts = np.flatnonzero(cut)
    bounds = np.append(starts, len(raw)).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(raw))])
    return np.searchsorted(offsets, starts, side="right") - 1, pieces


def gives_back(ids: np.ndarray, n: np.ndarray, pieces: list[bytes], side: Side) -> np.ndarray:
    """Whether the bytes of each piece's tokens (``ids``, one piece after the other, ``n`` of each) are the piece's bytes."""
    ends = np.cumsum(n)
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    total = np.concatenate([[0], np.cumsum(side.length[ids])])
    same = np.diff(total[ends], prepend=0) == size
    told, whole = b"".join(map(side.bytes.__getitem__, ids[np.repeat(same, n)].tolist())), b"".join(compress(pieces, same.tolist()))
    if told != whole:       # pieces of equal length that differ
        bounds = np.cumsum(size[same])
        differ = np.flatnonzero(np.frombuffer(told, np.uint8) != np.frombuffer(whole, np.uint8))
        same[np.flatnonzero(same)[np.searchsorted(bounds, differ, side="right")]] = False
    return same


def flat_ids(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())), n


def split_runs(runs: list[list[bytes]], side: Side) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Runs of pieces encoded as one text each: ids, how many each piece has, and which runs came back with a token end at the end
    of each piece. A run is a text that ``cut_pieces`` cuts into its pieces. Of other runs the numbers mean nothing."""
    joined = [b"".join(r) for r in runs]
    flat, n = flat_ids(side.encode_pieces([j.decode() for j in joined]))
    good = gives_back(flat, n, joined, side)
    pieces = np.fromiter(map(len, runs), np.int64, len(runs))
    counts, whole = np.zeros(int(pieces.sum()), np.int64), np.repeat(good, pieces)
    ends = np.cumsum(side.length[flat[np.repeat(good, n)]])
    bounds = np.cumsum(np.fromiter(map(len, chain.from_iterable(runs)), np.int64, len(whole))[whole])
    place = np.searchsorted(ends, bounds)
    met = np.ones(len(whole), bool)
    met[whole] = ends[place] == bounds
    counts[whole] = np.diff(place, prepend=-1)
    run = np.repeat(np.arange(len(runs)), pieces)
    crossed = np.unique(run[~met])
    # ids of the runs that are not whole are left out, and so have no pieces' counts
    flat = flat[np.repeat(good, n)]
    good[crossed] = False
    return (flat, counts), good


class Known:
    """Ids of both sides of the distinct pieces seen so far, as flat arrays; ``whole``: both give back the piece's bytes."""

    def __init__(self, sides: tuple[Side, Side], limit: int = KNOWN):
        self.sides, self.limit = sides, limit
        self.forget()

    def forget(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.whole = np.zeros(0, bool)
        self.flat = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.start = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def append(self, ids: list[tuple[np.ndarray, np.ndarray]], whole: np.ndarray) -> None:
        """``ids``: for each side the ids, one piece after the other, and how many each has."""
        for k in (0, 1):
            self.flat[k] = np.concatenate([self.flat[k], ids[k][0]])
            self.start[k] = np.concatenate([self.start[k], self.start[k][-1] + np.cumsum(ids[k][1])])
        self.whole = np.append(self.whole, whole)

    def add(self, pieces: list[bytes]) -> None:
        """Encodes pieces not seen before, those that can be joined ``JOINED`` at a time."""
        joinable = [p for p in pieces if p[0] in (32, 10) and 32 < p[-1] < 127]
        runs = [joinable[i:i + JOINED] for i in range(0, len(joinable), JOINED)]
        found, good = zip(*(split_runs(runs, side) for side in self.sides), strict=True)
        good = good[0] & good[1]
        kept = np.repeat(good, np.fromiter(map(len, runs), np.int64, len(runs)))
        first = list(compress(joinable, kept.tolist()))
        taken = set(first)
        rest = [p for p in pieces if p not in taken]
        single = [flat_ids(side.encode_pieces([p.decode() for p in rest])) for side in self.sides]
        whole = np.ones(len(rest), bool)
        for side, (flat, n) in zip(self.sides, single, strict=True):
            whole &= gives_back(flat, n, rest, side)
        ids = []
        for (flat, n), more in zip(found, single, strict=True):
            ids.append((np.concatenate([flat[np.repeat(kept, n)], more[0]]), np.concatenate([n[kept], more[1]])))
        self.slot.update(zip([*first, *rest], range(len(self.whole), len(self.whole) + len(pieces)), strict=True))
        self.append(ids, np.append(np.ones(len(first), bool), whole))

    def slots(self, pieces: list[bytes]) -> np.ndarray:
        if len(self.whole) + len(pieces) > self.limit:
            self.forget()
        new = [p for p in pieces if p not in self.slot]
        if new:
            self.add(new)
        return np.fromiter(map(self.slot.__getitem__, pieces), np.int64, len(pieces))

    def take(self, k: int, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of side ``k`` of the pieces in ``slots``, one after the other, and how many each has."""
        n = self.start[k][slots + 1] - self.start[k][slots]
        return self.flat[k][np.repeat(self.start[k][slots], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)], n


def encode_texts(texts: list[str | None], known: Known) -> list[tuple[np.ndarray, np.ndarray]]:
    """For both sides: ids of all texts, one after the other, and the text of each id. Texts without tokens: see the module."""
    filled = [i for i, t in enumerate(texts) if t]
    if not filled:
        return [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * 2
    number, pieces = cut_pieces([texts[i] for i in filled])
    distinct = pieces.dictionary_encode()
    slot = known.slots(distinct.dictionary.to_pylist())[distinct.indices.to_numpy()]
    doc = np.array(filled)[number]
    odd = np.unique(doc[~known.whole[slot]])        # texts with a piece that does not come back: encoded as a whole, which decides
    if len(odd):
        ids = tokens_of([texts[i] for i in odd], *known.sides)
        first = len(known.whole)
        known.append([flat_ids(x) for x in ids], np.zeros(len(odd), bool))
        stay = ~np.isin(doc, odd)
        doc, slot = np.append(doc[stay], odd), np.append(slot[stay], first + np.arange(len(odd)))
        order = np.argsort(doc, kind="stable")
        doc, slot = doc[order], slot[order]
    out = []
    for k in (0, 1):
        ids, n = known.take(k, slot)
        out.append((ids, np.repeat(doc, n)))
    return out


def frame(ids: np.ndarray, doc: np.ndarray, side: Side) -> pd.DataFrame:
    """doc, id, start, end, place of all tokens; documents lie one after the other on the byte axis."""
    end = np.cumsum(side.length[ids])
    return pd.DataFrame({"doc": doc, "id": ids, "start": end - side.length[ids], "end": end, "place": np.arange(len(ids))})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of tokens of one document that share a byte: each start meets the token that covers it. The tokens of both
    sides cover the same bytes of the same documents, so that a start's place on the byte axis names its document."""
    if a.empty:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = ["start", "place"]
    left = pd.merge_asof(a[starts], b[starts], on="start", suffixes=("", "_other"))
    right = pd.merge_asof(b[starts], a[starts], on="start", suffixes=("", "_other"))
    links = np.sort(np.concatenate([left["place"].to_numpy() * len(b) + left["place_other"].to_numpy(),
                                    right["place_other"].to_numpy() * len(b) + right["place"].to_numpy()]))
    links = links[np.append(True, links[1:] != links[:-1])]
    return links // len(b), links % len(b)


def groups(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of each token of A and of B: a group ends where tokens of both sides end."""
    cuts = np.intersect1d(a["end"].to_numpy(), b["end"].to_numpy(), assume_unique=True)
    return (np.searchsorted(cuts, a["start"].to_numpy(), side="right"), np.searchsorted(cuts, b["start"].to_numpy(), side="right"))


def written_groups(a: pd.DataFrame, b: pd.DataFrame, group_a: np.ndarray, group_b: np.ndarray, side: Side, other: Side, n: int) -> list[str]:
    """Each document's groups as text: ``a1,a2|b1;a3|b2,b3``."""
    def last(group: np.ndarray) -> np.ndarray:
        return np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool)

    name_a = a["id"].to_numpy() + len(side.bytes) * last(group_a)                  # ',' or '|' behind it
    name_b = b["id"].to_numpy() + 2 * len(other.bytes) * last(group_b)             # ',' or ';' behind it
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    shift = len(side.written)
    table = [*side.written, *other.written]
    names = np.concatenate([name_a, name_b + shift])[order].tolist()
    ends = np.cumsum(np.bincount(a["doc"], minlength=n) + np.bincount(b["doc"], minlength=n)).tolist()
    out, at = [], 0
    for end in ends:
        out.append("".join([table[i] for i in names[at:end]])[:-1])
        at = end
    return out


def align(texts: list[str | None], known: Known) -> dict:
    """Per text: n_a, n_b, n_groups, n_links, the written groups; and its distinct id pairs (``pair``) with their
    numbers of links (``times``), one text after the other (``pairs`` of them)."""
    n = len(texts)
    side, other = known.sides
    a, b = (frame(*ids, s) for ids, s in zip(encode_texts(texts, known), known.sides, strict=True))
    group_a, group_b = groups(a, b)
    place_a, place_b = overlaps(a, b)
    doc_a = a["doc"].to_numpy()
    first = np.append(True, group_a[1:] != group_a[:-1])[:len(group_a)]
    doc = doc_a[place_a]
    pair = a["id"].to_numpy()[place_a] * SIDE + b["id"].to_numpy()[place_b]
    if n <= 1 << 23:        # document and pair as one number, which sorts faster than both
        key = np.sort(doc << PAIR_BITS | pair)
        doc, pair = key >> PAIR_BITS, key & ((1 << PAIR_BITS) - 1)
    else:
        order = np.lexsort((pair, doc))
        doc, pair = doc[order], pair[order]
    start = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1]))[:len(doc)])
    return {"n_a": np.bincount(doc_a, minlength=n), "n_b": np.bincount(b["doc"], minlength=n),
            "n_groups": np.bincount(doc_a[first], minlength=n), "n_links": np.bincount(doc, minlength=n),
            "groups": written_groups(a, b, group_a, group_b, side, other, n),
            "pair": pair[start], "times": np.diff(np.append(start, len(doc))), "pairs": np.bincount(doc[start], minlength=n)}


_PER_DOC = ["n_a", "n_b", "n_groups", "n_links"]


def make_blocks(docs: DataFrame, path_a: str, path_b: str, digest: bool, block_links: int = BLOCK_LINKS) -> DataFrame:
    """The stored table of blocks: per document the counts, its groups (or their digest) and its pairs by number; per block the dictionary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known((byte_level_side(path_a), piece_side(path_b)))
        made, ids, kept = 0, [], []

        def block() -> pa.RecordBatch:
            pair = np.concatenate([k["pair"] for k in kept])
            distinct, number, n_docs = np.unique(pair, return_inverse=True, return_counts=True)
            per_doc = {c: pa.array([np.concatenate([k[c] for k in kept])], pa.list_(pa.int64())) for c in _PER_DOC}
            return pa.RecordBatch.from_pydict({
                "block": pa.array([(TaskContext.get().partitionId() << 32) + made], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())),
                **per_doc, "groups": pa.array([[g for k in kept for g in k["groups"]]], pa.list_(pa.string())),
                "sizes": [pack(np.concatenate([k["pairs"] for k in kept]))], "numbers": [pack(number)],
                "times": [pack(np.concatenate([k["times"] for k in kept]))],
                "pairs": pa.array([distinct], pa.list_(pa.int64())), "docs": pa.array([n_docs], pa.list_(pa.int64()))})

        for batch in batches:
            for part in text_slices(batch):
                found = align(part.column("text").to_pylist(), known)
                if digest:
                    found["groups"] = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found["groups"]]
                kept.append(found)
                ids += part.column("doc_id").to_pylist()
                if sum(len(k["pair"]) for k in kept) >= block_links:
                    yield block()
                    made, ids, kept = made + 1, [], []
        if ids:
            yield block()

    rows = docs.mapInArrow(run, "block long, ids array<long>, " + ", ".join(f"{c} array<long>" for c in _PER_DOC)
                           + ", groups array<string>, sizes binary, numbers binary, times binary, pairs array<long>, docs array<long>")
    spark = docs.sparkSession
    name = f"quantleaf_aligned_{uuid.uuid4().hex}"
    (rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").format("parquet")
         .option("compression", "zstd").option("path", scratch_dir(spark, "aligned")).saveAsTable(name))
    blocks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")     # the catalog entry only: the files at the given path stay
    return blocks


def count_pairs(blocks: DataFrame) -> DataFrame:
    """Corpus-wide counts of the dictionaries' entries, packed by block (block, numbers, counts), and rows without a
    block that hold the highest count of A ids among a task's pairs (numbers: the ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            block, number, pair, count = (batch.column(c).to_numpy() for c in ("block", "number", "pair", "count"))
            a = pair // SIDE
            best = np.concatenate([best, np.zeros(max(0, int(a.max()) + 1 - len(best)), np.int64)])
            np.maximum.at(best, a, count)
            order = np.lexsort((number, block))
            for rows in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                yield pa.RecordBatch.from_pydict({"block": pa.array([block[rows[0]]], pa.int64()),
                                                  "numbers": [number[rows].astype("<i8").tobytes()], "counts": [count[rows].astype("<i8").tobytes()]})
        seen = np.flatnonzero(best)
        if len(seen):
            yield pa.RecordBatch.from_pydict({"block": pa.array([None], pa.int64()), "numbers": [seen.astype("<i8").tobytes()],
                                              "counts": [best[seen].astype("<i8").tobytes()]})

    entries = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("number", "entry"))
    whole = entries.select("block", F.col("number").cast("long").alias("number"), "entry.pairs", "entry.docs").withColumnRenamed("pairs", "pair")
    counted = whole.select("block", "number", "pair", F.sum("docs").over(Window.partitionBy("pair")).alias("count"))
    return materialise(counted.mapInArrow(run, "block long, numbers binary, counts binary"), "pair-counts")


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None,
                    digest: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (as text, or its SHA-256 with ``digest``).

    ``path_a``, ``path_b``: files of a byte-level and a piece tokenizer that all executors can read."""
    path_a, path_b = path_a or model_path(MODEL_A), path_b or model_path(MODEL_B)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = make_blocks(rows, path_a, path_b, digest)
    counted = count_pairs(blocks)
    highest: dict[int, int] = {}
    for r in counted.where("block IS NULL").toLocalIterator():        # per task, at most one number per entry of A's vocabulary
        for a, c in zip(np.frombuffer(r.numbers, "<i8").tolist(), np.frombuffer(r.counts, "<i8").tolist(), strict=True):
            highest[a] = max(c, highest.get(a, 0))
    best = np.zeros(max(highest, default=0) + 1, np.int64)
    best[list(highest)] = list(highest.values())
    shared = docs.sparkSession.sparkContext.broadcast(best)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                pair = row["pairs"].values.to_numpy()
                count = np.zeros(len(pair), np.int64)
                for part in row["parts"].as_py() or []:
                    count[np.frombuffer(part["numbers"], "<i8")] = np.frombuffer(part["counts"], "<i8")
                top = count == shared.value[pair // SIDE]
                number, times = unpack(row["numbers"].as_py()), unpack(row["times"].as_py()).astype(np.int64)
                ends = np.cumsum(unpack(row["sizes"].as_py()).astype(np.int64))

                def per_doc(values: np.ndarray) -> np.ndarray:
                    total = np.concatenate([[0], np.cumsum(values)])
                    return np.diff(total[ends], prepend=0)

                yield pa.RecordBatch.from_pydict({
                    "doc_id": row["ids"].values, **{c: row[c].values for c in _PER_DOC}, "n_best": per_doc(times * top[number]),
                    "count_sum": per_doc(times * count[number]), "groups": row["groups"].values})

    parts = counted.where("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("numbers", "counts")).alias("parts"))
    return (blocks.drop("docs").join(parts, "block", "left").drop("block")
                  .mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"))


def op11_query(docs: DataFrame) -> DataFrame:
    return align_documents(docs, digest=True).withColumnRenamed("groups", "groups_sha256")
