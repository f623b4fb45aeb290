"""Blocks of documents as numbered pre-tokens: what token counting and BPE encoding share.

Texts are cut into pre-tokens that a tokenizer never merges across. A block is a run of documents of one
task, of bounded size; inside it each distinct pre-token has a number, and a document is a list of
numbers (its pre-tokens in order, or the distinct ones with their frequencies).

    blocks      one row per block: ids, packed numbers, and the block's dictionary of pre-tokens
    encoded     the dictionaries' entries, brought together by pre-token (one shuffle), so that each distinct
                pre-token of the corpus is encoded once; the values go back packed, by block
    resolved    blocks joined with their values

Blocks are written to a table bucketed by block in the shared folder, so the join shuffles the values only,
never the documents. A pre-token occurs at most once per block, so no key is hot within a partition.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import scratch_dir, text_slices

BLOCK_CHARS = 32_000_000       # a block ends at this size, or with its task
ENCODE_AT_ONCE = 200_000       # distinct pre-tokens encoded together


def pack(values) -> bytes:
    """Non-negative integers below 2**32 as bytes: split into byte planes and compressed."""
    a = np.ascontiguousarray(values, dtype="<u4")
    return zstandard.ZstdCompressor(level=3).compress(a.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def make_blocks(docs: DataFrame, split: Callable[[str], list[str]], bags: bool, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The table of blocks of ``docs`` (doc_id, text); ``bags``: distinct pre-tokens with frequencies instead of sequences."""
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        place, numbers, times, ids, sizes, ends, chars = {}, [], [], [], [], [0], 0

        def block() -> pa.RecordBatch:
            flat = np.concatenate(numbers) if numbers else np.zeros(0, np.uint32)
            freq = np.concatenate(times) if times else np.zeros(0, np.uint32)
            key = (TaskContext.get().partitionId() << 32) + made
            return pa.RecordBatch.from_pydict({
                "block": pa.array([key], pa.int64()), "ids": pa.array([ids], pa.list_(to_arrow_type(id_type))),
                "n_bytes": pa.array([sizes], pa.list_(pa.int64())), "ends": [pack(ends)], "numbers": [pack(flat)],
                "times": [pack(freq)], "tokens": pa.array([list(place)], pa.list_(pa.string()))})

        for batch in batches:
            for part in text_slices(batch):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    text = text or ""
                    found = split(text)
                    if bags:
                        bag = Counter(found)
                        found = list(bag)
                        times.append(np.fromiter(bag.values(), np.uint32, len(bag)))
                    numbers.append(np.fromiter((place.setdefault(t, len(place)) for t in found), np.uint32, len(found)))
                    ids.append(doc_id)
                    ends.append(ends[-1] + len(found))
                    sizes.append(len(text.encode()))
                    chars += len(text)
                    if chars >= block_chars:
                        yield block()
                        made += 1
                        place, numbers, times, ids, sizes, ends, chars = {}, [], [], [], [], [0], 0
        if ids:
            yield block()

    rows = docs.select("doc_id", "text").mapInArrow(
        run, f"block long, ids array<{id_type.simpleString()}>, n_bytes array<long>, ends binary, numbers binary, times binary, tokens array<string>")
    spark = docs.sparkSession
    name = f"quantleaf_blocks_{uuid.uuid4().hex}"
    (rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").format("parquet")
         .option("compression", "zstd").option("path", scratch_dir(spark, "blocks")).saveAsTable(name))
    blocks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")     # the catalog entry only: the files at the given path stay
    return blocks


def encode_once(blocks: DataFrame, encoder: Callable[[], Callable[[list[str]], list[list[int]]]]) -> DataFrame:
    """Values of all dictionary entries, packed by block: block, numbers, lengths, values.

    ``encoder()`` is called in the task and gives a function from distinct pre-tokens to lists of integers.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        distinct, block, number, entry = [], [], [], []

        def packed() -> Iterator[pa.RecordBatch]:
            values = encode(distinct)
            lengths = np.fromiter(map(len, values), np.int64, len(values))
            flat = np.fromiter((x for v in values for x in v), np.int64, int(lengths.sum()))
            starts = np.concatenate([[0], np.cumsum(lengths)])
            blocks_, numbers_, entries_ = np.concatenate(block), np.concatenate(number), np.concatenate(entry)
            order = np.lexsort((numbers_, blocks_))
            cuts = np.flatnonzero(np.diff(blocks_[order])) + 1
            for rows in np.split(order, cuts):
                n = lengths[entries_[rows]]
                place = np.repeat(starts[entries_[rows]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([blocks_[rows[0]]], pa.int64()), "numbers": [pack(np.diff(numbers_[rows], prepend=0))],
                    "lengths": [pack(n)], "values": [pack(flat[place])]})

        for batch in batches:           # rows come in order of the token
            if not batch.num_rows:
                continue
            tokens = batch.column("token")
            runs = tokens.to_pylist()
            at = np.empty(len(runs), np.int64)
            last = distinct[-1] if distinct else None
            for i, t in enumerate(runs):
                if t != last:
                    distinct.append(t)
                    last = t
                at[i] = len(distinct) - 1
            block.append(batch.column("block").to_numpy())
            number.append(batch.column("number").to_numpy().astype(np.int64))
            entry.append(at)
            if len(distinct) >= ENCODE_AT_ONCE or sum(map(len, entry)) >= 4 * ENCODE_AT_ONCE:
                yield from packed()
                distinct, block, number, entry = [], [], [], []
        if distinct:
            yield from packed()

    spark = blocks.sparkSession
    entries = blocks.select("block", F.posexplode("tokens").alias("number", "token"))
    return (entries.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "token").sortWithinPartitions("token")
                   .mapInArrow(run, "block long, numbers binary, lengths binary, values binary"))


def resolve(blocks: DataFrame, encoded: DataFrame, finish: Callable[[dict, np.ndarray, np.ndarray], dict], schema: str) -> DataFrame:
    """Rows of the documents: ``finish(block, starts, values)`` gets a block's row (ids, n_bytes, ends, numbers,
    times as arrays) and the values of its pre-tokens (those of number k are values[starts[k]:starts[k + 1]])."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                parts = row["parts"].as_py() or []
                number = [np.cumsum(unpack(p["numbers"]), dtype=np.int64) for p in parts]
                length = [unpack(p["lengths"]).astype(np.int64) for p in parts]
                size = 1 + max((int(k[-1]) for k in number), default=-1)
                lengths = np.zeros(size, np.int64)
                for k, n in zip(number, length, strict=True):
                    lengths[k] = n
                starts = np.concatenate([[0], np.cumsum(lengths)])
                values = np.zeros(int(starts[-1]), np.uint32)
                for k, n, p in zip(number, length, parts, strict=True):
                    place = np.repeat(starts[k], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    values[place] = unpack(p["values"])
                block = {"ids": row["ids"].values, "n_bytes": row["n_bytes"].values.to_numpy(),
                         "ends": unpack(row["ends"].as_py()).astype(np.int64),
                         **{c: unpack(row[c].as_py()) for c in ("numbers", "times")}}
                row = parts = number = length = place = None
                yield pa.RecordBatch.from_pydict(finish(block, starts, values))

    parts = encoded.groupBy("block").agg(F.collect_list(F.struct("numbers", "lengths", "values")).alias("parts"))
    return blocks.drop("tokens").join(parts, "block", "left").select(
        "ids", "n_bytes", "ends", blocks["numbers"], "times", "parts").mapInArrow(run, schema)
