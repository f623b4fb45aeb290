"""Ranked lexical search, reversed: documents stream through an inverted index over the items' terms.

1. The items are dealt by hash into blocks of about ``INDEX_BYTES`` of text, so that what is broadcast has a bound; one block
   after the other is searched (one block, for up to 64 MB of items).
2. One map over the texts counts, per document, all terms and those of the block; the counts are stored as Parquet.
3. One aggregate gives the number of documents, of their terms, and the document frequency of each term of the block.
4. The stored counts stream through the broadcast index: a term's postings (item, times) turn a document's counts into the
   scores of all items that share a term with it. A task keeps one heap of the ``k`` best per item, as arrays.
5. The heaps meet by item, first within groups of tasks, then all: k rows per item and task, never a list of matches.

Terms are runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased. Scores are 64-bit integers as the formula
states: sum over the item's terms of w * ((10**9 * tf) div (1000 * tf + 8 * m)).

Defined results: null or empty texts have no terms; such documents count for nothing and are never found, such items find
nothing. Each row of documents is a document of its own, whatever its id; equal scores are ordered by id, null ids
last. Equal rows of items count once; items with one id and different texts are ranked each by itself. Empty tables give no rows.
Other columns of the inputs are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialise, text_slices

K = 10
INDEX_BYTES = 64_000_000       # item text per broadcast index
CELLS = 400_000                # scores (documents x items) held at once in a task
EXPANDED = 4_000_000           # products (count x posting) held at once; one document can exceed it by its own postings
EXACT = 2 ** 53                # sums below are exact in float64
MERGE_GROUPS = 64              # tasks' heaps meet in this many groups before they meet by item
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def terms(text: str | None) -> list[bytes]:
    return _TERM.findall(text.encode().translate(_LOWER)) if text else []


class Index:
    """Inverted index of some items: postings[starts[t]:starts[t + 1]] are the (item, times) of term number t."""

    def __init__(self, items: list[tuple]):
        self.ids = [item_id for item_id, _ in items]
        bags = [Counter(terms(text)) for _, text in items]
        self.number = {t: i for i, t in enumerate(sorted(set().union(*bags)))} if bags else {}
        entries = sorted((self.number[t], item, times) for item, bag in enumerate(bags) for t, times in bag.items())
        rows = np.array(entries, np.int64).reshape(-1, 3)
        self.starts = np.searchsorted(rows[:, 0], np.arange(len(self.number) + 1))
        self.item, self.times = rows[:, 1].copy(), rows[:, 2].copy()
        self.longest = max((sum(bag.values()) for bag in bags), default=0)


def _count(number: dict[bytes, int], id_type: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                ids, sizes, found, times = [], [], [], []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    words = terms(text)
                    if words:
                        known = [(number[t], c) for t, c in Counter(words).items() if t in number]
                        ids.append(doc_id)
                        sizes.append(len(words))
                        found.append([t for t, _ in known])
                        times.append([c for _, c in known])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, pa.int64()), "n": pa.array(sizes, pa.int64()),
                    "terms": pa.array(found, pa.list_(pa.int32())), "times": pa.array(times, pa.list_(pa.int64()))})
    return run


class Heaps:
    """The k best (score, id) of each item so far; equal scores: smaller id first, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.n = k, n_items
        self.item = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)
        self.doc = np.zeros(0, np.int64)
        self.floor = np.zeros(n_items, np.int64)     # a score below it cannot enter; an equal one can, by its id

    def add(self, item: np.ndarray, score: np.ndarray, no_id: np.ndarray, doc: np.ndarray) -> None:
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        no_id, doc = np.concatenate([self.no_id, no_id]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, no_id, -score, item))
        sorted_item = item[order]
        rank = np.arange(len(order)) - np.searchsorted(sorted_item, sorted_item)
        order = order[rank < self.k]
        self.item, self.score, self.no_id, self.doc = item[order], score[order], no_id[order], doc[order]
        full = rank[rank < self.k] == self.k - 1
        self.floor[self.item[full]] = self.score[full]


def _search(index: Index, weights: np.ndarray, n_docs: int, n_terms: int, k: int, number_base: int, id_type: pa.DataType):
    n_items, spread = len(index.ids), np.diff(index.starts)
    exact = int(weights.max(initial=0)) * 1_000_000 * index.longest < EXACT

    def scores(owner: np.ndarray, term: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        """Scores of ``rows`` documents and all items: ``value`` of each (document, term), times the postings."""
        width = spread[term]
        at = np.repeat(index.starts[term], width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        cell = np.repeat(owner * n_items, width) + index.item[at]
        part = np.repeat(value, width) * index.times[at]
        if exact:
            return np.bincount(cell, part, rows * n_items).astype(np.int64).reshape(rows, n_items)
        total = np.zeros(rows * n_items, np.int64)
        np.add.at(total, cell, part)
        return total.reshape(rows, n_items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(n_items, k)
        for batch in batches:
            n = batch.column("n").to_numpy()
            doc = batch.column("doc_id").fill_null(0).to_numpy()
            no_id = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            lists = batch.column("terms")
            sizes = lists.value_lengths().to_numpy().astype(np.int64)
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = batch.column("times").flatten().to_numpy()
            owner = np.repeat(np.arange(len(n)), sizes)
            m = 25 + (75 * n * n_docs) // n_terms
            value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
            edges = np.concatenate([[0], np.cumsum(sizes)])
            work = np.concatenate([[0], np.cumsum(spread[term])])[edges]
            step, a = max(1, CELLS // n_items), 0
            while a < len(n):
                b = min(a + step, len(n), max(a + 1, int(np.searchsorted(work, work[a] + EXPANDED, side="right")) - 1))
                s = slice(edges[a], edges[b])
                found = scores(owner[s] - a, term[s], value[s], b - a)
                row, item = np.nonzero((found > 0) & (found >= heaps.floor))
                if len(row):
                    heaps.add(item, found[row, item], no_id[a + row], doc[a + row])
                a = b
        if len(heaps.item):
            yield pa.RecordBatch.from_pydict({
                "item": pa.array(number_base + heaps.item, pa.int64()),
                "item_id": pa.array([index.ids[i] for i in heaps.item], id_type),
                "doc_id": pa.array(heaps.doc, pa.int64(), mask=heaps.no_id), "score": pa.array(heaps.score, pa.int64())})
    return run


def _best(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text", index_bytes: int = INDEX_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item, scores above 0 only."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    wanted = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text")).where("text IS NOT NULL").distinct()
    id_type = to_arrow_type(wanted.schema["item_id"].dataType)
    id_name = wanted.schema["item_id"].dataType.simpleString()
    total = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-total // index_bytes) or 1
    dealt = wanted.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))
    out, base = None, 0
    for block in range(n_blocks):
        rows = dealt.where(F.col("part") == block).select("item_id", "text").collect()     # about index_bytes
        index = Index(sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        if not index.number:
            continue
        number = spark.sparkContext.broadcast(index.number)
        counts = materialise(texts.mapInArrow(lambda b, number=number: _count(number.value, id_name)(b),
                                              "doc_id long, n long, terms array<int>, times array<long>"), "search-counts")
        sizes = counts.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not sizes.docs:
            continue
        weights = np.zeros(len(index.number), np.int64)
        for r in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():    # one row per term of the block
            weights[r.term] = math.floor(1000 * math.log((2 * sizes.docs + 2) / (2 * r["count"] + 1)))
        shared = spark.sparkContext.broadcast((index, weights))
        heaps = counts.mapInArrow(
            lambda b, s=shared, z=sizes, base=base: _search(*s.value, z.docs, z.terms, k, base, id_type)(b),
            f"item long, item_id {id_name}, doc_id long, score long")
        out = heaps if out is None else out.unionByName(heaps)
        base += len(index.ids)
    if out is None:
        return spark.createDataFrame([], f"item_id {id_name}, rank int, doc_id long, score long")
    grouped = out.withColumn("tasks", F.spark_partition_id() % MERGE_GROUPS)
    nearly = _best(grouped, ["item", "tasks"], k).drop("rank", "tasks")
    return _best(nearly, ["item"], k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op13_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return search(docs, benchmark)


_TERMS_SQL = (r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE_SQL = f"""
WITH doc_terms AS (
  SELECT r, doc_id, term, count(*) AS tf
  FROM (SELECT r, doc_id, unnest({_TERMS_SQL.format('text')}) AS term FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents))
  GROUP BY ALL),
sizes AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM doc_terms GROUP BY r),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
item_terms AS (
  SELECT i, item_id, term, count(*) AS times
  FROM (SELECT row_number() OVER () AS i, item_id, unnest({_TERMS_SQL.format('text')}) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM doc_terms, corpus GROUP BY term),
parts AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) AS part
  FROM doc_terms JOIN sizes USING (r) JOIN weights USING (term), corpus
  WHERE term IN (SELECT term FROM item_terms)),
scored AS (
  SELECT i, item_id, r, doc_id, CAST(sum(times * part) AS BIGINT) AS score
  FROM item_terms JOIN parts USING (term) GROUP BY ALL)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS place FROM scored WHERE score > 0)
WHERE place <= {K}
"""
