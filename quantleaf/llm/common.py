"""Helpers shared by the operators: scratch tables, Arrow batches, vectorised word hashing."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text bytes handled at once inside a task: bounds the numpy temporaries (about 60 bytes each).
SLICE_BYTES = 2_000_000

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)

#: 1 for the bytes of white space: space and 0x09-0x0D.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


# ------------------------------------------------------------------ scratch tables


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir; a local temp folder only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quantleaf-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage, survives
    lost executors and fixes the result of tasks whose row order could differ when run again."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_tasks(df: DataFrame, rows: int, per_task: int) -> DataFrame:
    """``df`` in about ``rows / per_task`` tasks, as many as there are cores at least: a small table is not spread over all shuffle
    partitions, which costs more than its work. Never more tasks than ``df`` has."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_task)))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a cluster gets it by --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: null)."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % F.lit(modulus)


# ------------------------------------------------------------------ Arrow batches


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in slices of about ``limit`` text bytes (one row at least)."""
    sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in one array, and the n + 1 offsets of the rows (null: empty)."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


# ------------------------------------------------------------------ hashing


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection on 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _M1
        x = (x ^ (x >> _U(27))) * _M2
        return x ^ (x >> _U(31))


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _MULT, dtype=_U), dtype=_U)


def sequence_hash(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each run ``values[starts[k] : starts[k] + lengths[k]]``; the runs lie one
    after the other, cover ``values`` and are not empty."""
    if len(starts) == 0:
        return np.zeros(0, _U)
    power = _powers(int(lengths.max()))
    place = np.arange(len(values)) - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        terms = mix64(values + _MULT) * power[place]
        sums = np.add.reduceat(terms, starts)
        return mix64(sums + lengths.astype(_U) * _M2)


class Words:
    """Words (runs of bytes that are not white space) of many texts, as arrays.

    start, end: byte places; doc: row of each word; hash: 64-bit hash of its bytes;
    first, count: for each row its first word and its number of words.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False):
        n_docs = len(offsets) - 1
        solid = ~IS_SPACE[raw]
        begins, ends = solid.copy(), solid.copy()
        if len(raw):
            begins[1:] &= ~solid[:-1]
            ends[:-1] &= ~solid[1:]
            edges = offsets[1:-1]
            inner = edges[(edges > 0) & (edges < len(raw))]
            begins[inner] |= solid[inner]
            ends[inner - 1] |= solid[inner - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1 if len(self.start) else np.zeros(0, np.int64)
        self.count = np.bincount(self.doc, minlength=n_docs).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)[:-1]]) if n_docs else np.zeros(0, np.int64)
        length = self.end - self.start
        letters = raw[solid]
        letters = (_LOWER[letters] if lower else letters).astype(_U)
        begin = np.concatenate([[0], np.cumsum(length)[:-1]]).astype(np.int64) if len(length) else np.zeros(0, np.int64)
        self.hash = sequence_hash(letters, begin, length)
