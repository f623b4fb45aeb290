"""Document fingerprints: a Merkle tree over word groups, paragraphs and sections.

A paragraph is a line of the text; its digest covers its bytes. Below it lie its word groups, short runs of words cut at
places that depend on the words alone. A section is a run of paragraphs that ends where a paragraph's digest says so, so an
edit moves no limits behind it; its digest covers its paragraphs' digests, and the root covers the sections' digests and their
number. Equal roots mean equal texts.

Two trees are compared from the root down (``compare_trees``): equal sections count whole and are not entered, in the others
equal paragraphs count whole, and only in the paragraphs left are word groups compared. What is left locates the edits.
Likeness is the Dice coefficient of the word groups found equal on that way (1 for equal roots, below 1 for others).

    fingerprint = root (64 hex digits), then for each section ";" digest (8 signs), for each of its paragraphs
                  "." digest (6 signs) and word groups (5 signs each)

The next document in descending order of ids is found by ranges of ids: rows are dealt by range and sorted within
it, and the first document of each range is copied to the range before it. An id so frequent that it holds several limits (null
ids too) has as many ranges, by a hash of the text. Only the limits and the first row's id and hash of each range (a few times
``MAX_RANGES`` at most) reach the driver.

Defined results: a null or empty text has one empty paragraph, no word groups, and the fingerprint of the empty text.
Rows with equal ids follow each other in order of a hash of the text; null ids come after all others. A
table of one row is its own next document. An empty table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, Words, buffer_of, mix64, sequence_hash

RANGES_PER_TASK = 8
MAX_RANGES = 4096
GROUP_MASK = 3            # a word group ends after one word in four
SECTION_MASK = 7          # a section ends after one paragraph in eight
_U = np.uint64
_SIGNS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", np.uint8)
_VALUES = np.zeros(256, np.int64)
_VALUES[_SIGNS] = np.arange(64)
_LOWEST = -(1 << 63)
DIGEST_BYTES = (6, 4)     # bytes of a section's and of a paragraph's digest that are kept for comparing


@dataclass(frozen=True)
class Tree:
    """The root, sections as (first paragraph, end, digest), paragraphs as digests, and all word groups in order:
    paragraph ``i`` has ``groups[limits[i]:limits[i + 1]]``."""
    root: str
    sections: tuple[tuple[int, int, bytes], ...]
    paragraphs: tuple[bytes, ...]
    groups: np.ndarray
    limits: np.ndarray


def trees(texts: list[str]) -> list[Tree]:
    out = []
    for text, (groups, limits) in zip(texts, word_groups(texts), strict=True):
        paragraphs = tuple(hashlib.blake2b(p.encode(), digest_size=16).digest() for p in text.split("\n"))
        sections, first = [], 0
        for i, digest in enumerate(paragraphs):
            if digest[0] & SECTION_MASK == 0 or i == len(paragraphs) - 1:
                sections.append((first, i + 1, hashlib.sha256(b"s" + b"".join(paragraphs[first:i + 1])).digest()))
                first = i + 1
        root = hashlib.sha256(b"r%d:" % len(sections) + b"".join(s[2] for s in sections)).hexdigest()
        out.append(Tree(root, tuple((f, e, d[:DIGEST_BYTES[0]]) for f, e, d in sections),
                        tuple(p[:DIGEST_BYTES[1]] for p in paragraphs), groups, limits))
    return out


@dataclass(frozen=True)
class Comparison:
    """Likeness of two trees, and the numbers of the paragraphs of each that lie in no equal branch."""
    likeness: float
    left: list[int]
    right: list[int]


def _without(branches: list[tuple[bytes, range]], equal: Counter) -> list[int]:
    """Paragraphs below those branches that are not among the ``equal`` ones (each used as often as it is counted)."""
    unused, out = Counter(equal), []
    for digest, paragraphs in branches:
        if unused[digest]:
            unused[digest] -= 1
        else:
            out.extend(paragraphs)
    return out


def _open_groups(t: Tree, paragraphs: list[int]) -> np.ndarray:
    parts = [t.groups[t.limits[i]:t.limits[i + 1]] for i in paragraphs]
    return np.concatenate(parts) if parts else t.groups[:0]


def compare_trees(a: Tree, b: Tree) -> Comparison:
    """From the root down; a branch that is equal on both sides is not entered."""
    if a.root == b.root:
        return Comparison(1.0, [], [])
    sections = [[(digest, range(first, end)) for first, end, digest in t.sections] for t in (a, b)]
    equal = Counter(d for d, _ in sections[0]) & Counter(d for d, _ in sections[1])
    below = [[(t.paragraphs[i], range(i, i + 1)) for i in _without(s, equal)] for t, s in zip((a, b), sections, strict=True)]
    equal = Counter(d for d, _ in below[0]) & Counter(d for d, _ in below[1])
    left, right = (_without(p, equal) for p in below)
    total = len(a.groups) + len(b.groups)
    if not len(a.groups) or not len(b.groups):
        return Comparison(0.0, left, right)
    in_a, in_b = _open_groups(a, left), _open_groups(b, right)
    common = len(a.groups) - len(in_a)         # below equal branches
    if len(in_a) and len(in_b):
        value_a, n_a = np.unique(in_a, return_counts=True)
        value_b, n_b = np.unique(in_b, return_counts=True)
        place = np.minimum(np.searchsorted(value_b, value_a), len(value_b) - 1)
        common += int(np.minimum(n_a, n_b[place])[value_b[place] == value_a].sum())
    return Comparison(min(2.0 * common / total, 1.0 - 1.0 / (total + 1)), left, right)


def word_groups(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text 30-bit hashes of its word groups, in order, and the limits of its paragraphs among them."""
    raw, offsets = buffer_of(pa.array(texts, pa.large_string()))
    words = Words(raw, offsets)
    n = len(words.start)
    breaks = np.flatnonzero(raw == 10)
    if not n:
        return [(np.zeros(0, np.int64), np.zeros(t.count("\n") + 2, np.int64)) for t in texts]
    line = np.searchsorted(breaks, words.start) + words.doc * (len(raw) + 1)
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = line[1:] != line[:-1]
    with np.errstate(over="ignore"):
        pair = words.hash.copy()
        pair[1:] += np.where(last[:-1], _U(0), words.hash[:-1] * _U(3))
    last |= (mix64(pair) & _U(GROUP_MASK)) == 0
    ends = np.flatnonzero(last) + 1
    starts = np.concatenate([[0], ends[:-1]])
    groups = (sequence_hash(words.hash, starts, ends - starts) >> _U(34)).astype(np.int64)
    cuts = np.searchsorted(words.doc[starts], np.arange(len(texts) + 1))
    place = words.start[starts]
    out = []
    for i in range(len(texts)):
        own = breaks[np.searchsorted(breaks, offsets[i]):np.searchsorted(breaks, offsets[i + 1])]
        limits = np.concatenate([[0], np.searchsorted(place[cuts[i]:cuts[i + 1]], own), [cuts[i + 1] - cuts[i]]])
        out.append((groups[cuts[i]:cuts[i + 1]], limits))
    return out


def _signs(values: np.ndarray, n: int) -> str:
    return _SIGNS[(values[:, None] >> (6 * np.arange(n))) & 63].tobytes().decode()


def _numbers(signs: str, n: int) -> np.ndarray:
    values = _VALUES[np.frombuffer(signs.encode(), np.uint8)].reshape(-1, n)
    return (values << (6 * np.arange(n))).sum(axis=1)


def fingerprint(t: Tree) -> str:
    groups = _signs(t.groups, 5)
    digests = _signs(np.array([int.from_bytes(d, "little") for d in t.paragraphs], np.int64), 6)
    sections = _signs(np.array([int.from_bytes(d, "little") for _, _, d in t.sections], np.int64), 8)
    limits = (5 * t.limits).tolist()
    return t.root + "".join(
        ";" + sections[8 * k:8 * k + 8] + "".join("." + digests[6 * i:6 * i + 6] + groups[limits[i]:limits[i + 1]] for i in range(first, end))
        for k, (first, end, _) in enumerate(t.sections))


def parsed(text: str) -> Tree:
    """The tree that a fingerprint holds."""
    root, *branches = text.split(";")
    sections, paragraphs, signs = [], [], []
    for branch in branches:
        digest, *below = branch.split(".")
        sections.append((len(paragraphs), len(paragraphs) + len(below), int(_numbers(digest, 8)[0]).to_bytes(DIGEST_BYTES[0], "little")))
        paragraphs.extend(int(_numbers(p[:6], 6)[0]).to_bytes(DIGEST_BYTES[1], "little") for p in below)
        signs.extend(p[6:] for p in below)
    limits = np.concatenate([[0], np.cumsum([len(p) // 5 for p in signs])])
    return Tree(root, tuple(sections), tuple(paragraphs), _numbers("".join(signs), 5), limits)


def compare(a: str, b: str) -> float:
    """Likeness of two fingerprints."""
    return compare_trees(parsed(a), parsed(b)).likeness


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the beginning of the following text."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def _fingerprint_rows(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (id, text, next text) in order; the next text mostly is the next row's."""
    texts = [r[1] for r in rows]
    following = []
    for i, r in enumerate(rows):
        if i + 1 < len(rows) and rows[i + 1][1] is r[2]:
            following.append(i + 1)
        else:
            following.append(len(texts))
            texts.append(r[2])
    changed = [edited(r[1], r[2]) for r in rows]
    old, new = trees(texts), trees(changed)
    edits = [compare_trees(old[i], t) for i, t in enumerate(new)]
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array([r[0] for r in rows], pa.int64()),
        "n_chars": pa.array([len(r[1]) for r in rows], pa.int64()),
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": [fingerprint(t) for t in old[:len(rows)]],
        "edited_fingerprint": [fingerprint(t) for t in new],
        "near_edited": pa.array([e.likeness for e in edits], pa.float64()),
        "near_next": pa.array([compare_trees(old[i], old[k]).likeness for i, k in enumerate(following)], pa.float64()),
        "differing": pa.array([e.left for e in edits], pa.list_(pa.int32()))})


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size, waiting = [], 0, None      # a row waits for its next document; copies wait for none
    for batch in batches:
        for doc_id, text, copy in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(),
                                      batch.column("copy").to_pylist(), strict=True):
            text = text or ""
            if waiting is not None:
                rows.append((*waiting, text))
                size += len(waiting[1])
                if size > SLICE_BYTES:
                    yield _fingerprint_rows(rows)
                    rows, size = [], 0
            waiting = None if copy else (doc_id, text)
    if rows:
        yield _fingerprint_rows(rows)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, text, range, copy), dealt by range and sorted: each row is followed by its next document."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = min(MAX_RANGES, RANGES_PER_TASK * tasks)
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST))
    limits = docs.select(F.percentile_approx(order, [k / n for k in range(1, n)], 10 * n).alias("q")).first()["q"]
    cuts, times = np.unique(np.array(limits or [], np.int64), return_counts=True)
    hot = times > 1
    # Range numbers rise with ids: one up to and with a limit; a frequent id has its own, in falling order of the texts' hashes.
    first = np.concatenate([[0], np.cumsum(np.where(hot, times + 1, 1))])

    def numbers(ids: np.ndarray, ties: np.ndarray) -> np.ndarray:
        place = np.searchsorted(cuts, ids, side="left")
        out = first[place]
        if hot.any():
            at = np.minimum(place, len(cuts) - 1)
            own = (cuts[at] == ids) & hot[at]
            share = (ties.astype(np.float64) + 2.0 ** 63) / 2.0 ** 64
            out = out + np.where(own, times[at] - np.minimum((share * times[at]).astype(np.int64), times[at] - 1), 0)
        return out

    @F.pandas_udf("int")
    def range_of(ids: pd.Series, ties: pd.Series) -> pd.Series:
        return pd.Series(numbers(ids.to_numpy(np.int64), ties.to_numpy(np.int64)))

    # Without frequent ids the texts need not be read here: all rows with a range's largest id are copied, the first by hash counts.
    by_text = F.xxhash64(F.coalesce(text_col, F.lit("")))
    tie = by_text if hot.any() else F.lit(0).cast("long")
    tops = {r["k"]: (r["top"]["o"], ~r["top"]["t"]) for r in docs.select(order.alias("o"), F.bitwise_not(tie).alias("t"))
            .groupBy(range_of("o", F.bitwise_not("t")).alias("k")).agg(F.max(F.struct("o", "t")).alias("top")).collect()}
    used = sorted(tops)
    above = {k: used[(i + 1) % len(used)] for i, k in enumerate(used)}

    @F.pandas_udf("array<int>")
    def ranges_of(ids: pd.Series, ties: pd.Series) -> pd.Series:
        own = numbers(ids.to_numpy(np.int64), ties.to_numpy(np.int64))
        return pd.Series([[k, above[k]] if (i, t) == tops[k] else [k] for i, t, k in zip(ids, ties, own, strict=True)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), order.alias("order"),
                       by_text.alias("tie"), tie.alias("range_tie"))
    rows = rows.select("doc_id", "text", "order", "tie", F.posexplode(ranges_of("order", "range_tie")).alias("pos", "range"))
    return (rows.select("doc_id", "text", "order", "tie", "range", (F.col("pos") == 1).alias("copy"))
                .repartition(tasks, "range").sortWithinPartitions("range", "copy", F.desc("order"), "tie"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_chars, the edited text's sha256, both fingerprints, likeness to the edited and the next text, and
    ``differing``: the paragraphs (from 0) in which the edited text differs, those in no equal branch."""
    return with_next(docs, id_col, text_col).select("doc_id", "text", "copy").mapInArrow(
        _fingerprint_batches, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                              "near_edited double, near_next double, differing array<int>")


def op3_query(docs: DataFrame) -> DataFrame:
    return fingerprints(docs)
