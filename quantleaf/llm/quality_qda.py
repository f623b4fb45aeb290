"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

A task computes transformed statistics of each whole text (log ratios of words, repeats, symbols,
case, punctuation and lines). The class means and covariances come from sums and cross products of all
labelled rows, added up by Spark. Each covariance is shrunk towards the pooled covariance and its
diagonal; its Cholesky factor is computed once and cached in the model. The score is the
logistic function of the difference of the two log densities (Mahalanobis distance and log determinant)
plus the log prior odds.

Only sums over classes reach the driver: 2 rows of 1 + d + d*d numbers, whatever the input's size.

Defined results: null and empty texts have the statistics of zero words and are scored like any other.
Labels that are null, or of other values than 0 and 1, are not used; a document with several label rows
counts once for each. Without rows of one class, every score is the other class's share (0.5 without any
labels). Null ids are scored, and count as not held out. Repeated rows are each scored. An empty table gives no
rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, buffer_of, crc_mod, materialise, text_slices

FEATURES = ("words", "word_length", "word_length_spread", "long_words", "distinct_words", "distinct_pairs", "stutter", "symbols",
            "exclaims", "bars", "capitals", "digits", "stops", "commas", "other_punctuation", "lines", "non_ascii")
THRESHOLD = 0.3
HELD_OUT = (5, 0)

_N_CLASSES = 11
_CLASS = np.zeros(256, np.int64)      # 0: none of them
for _i, _chars in enumerate((b"#*$%&<>@^~=+", b"!", b"|", bytes(range(65, 91)), bytes(range(48, 58)), b".?", b",",
                             b";:-_/\\()[]{}\"'", b"\n", bytes(range(128, 256))), start=1):
    _CLASS[list(_chars)] = _i


def _per_doc(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=n)


def _distinct(keys: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys per document."""
    packed = np.sort((doc.astype(np.uint64) << np.uint64(44)) | (keys >> np.uint64(20)))
    new = np.concatenate([[True], packed[1:] != packed[:-1]]) if len(packed) else np.zeros(0, bool)
    return np.bincount((packed[new] >> np.uint64(44)).astype(np.int64), minlength=n).astype(np.float64)


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Transformed statistics, one row per text."""
    n = len(offsets) - 1
    words = Words(raw, offsets)
    count = words.count.astype(np.float64)
    length = (words.end - words.start).astype(np.float64)
    mean = _per_doc(length, words.doc, n) / np.maximum(count, 1)
    spread = np.sqrt(np.maximum(_per_doc(length ** 2, words.doc, n) / np.maximum(count, 1) - mean ** 2, 0))
    same_doc = words.doc[1:] == words.doc[:-1]
    pair_doc = words.doc[1:][same_doc]
    with np.errstate(over="ignore"):
        pairs = ((words.hash[:-1] * np.uint64(3) + words.hash[1:]) * np.uint64(0x9E3779B97F4A7C15))[same_doc]
    stutter = _per_doc((words.hash[1:] == words.hash[:-1])[same_doc].astype(np.float64), pair_doc, n)
    doc_of_byte = np.repeat(np.arange(n), np.diff(offsets))
    chars = np.bincount(doc_of_byte * _N_CLASSES + _CLASS[raw], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES).astype(np.float64)
    symbols, exclaims, bars, capitals, digits, stops, commas, other, lines, high = chars.T[1:]
    size = np.diff(offsets).astype(np.float64)

    def rate(k: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.log((k + 0.5) / (of + 1.0))

    n_pairs = np.maximum(count - 1, 0)
    return np.stack([
        np.log1p(count), np.log1p(mean), np.log1p(spread), rate(_per_doc((length > 20).astype(np.float64), words.doc, n), count),
        rate(count - _distinct(words.hash, words.doc, n), count), rate(n_pairs - _distinct(pairs, pair_doc, n), n_pairs),
        rate(stutter, count), rate(symbols, count), rate(exclaims, count), rate(bars, count), rate(capitals, size),
        rate(digits, size), rate(stops, count), rate(commas, count), rate(other, count), rate(lines, count), rate(high, size),
    ], 1)


def _statistics_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch):
            x = statistics(*buffer_of(part.column("text")))
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), values], ["doc_id", "x"])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_statistics_batches, f"doc_id {kind}, x array<double>")


@dataclass
class QdaModel:
    """Class means, inverse Cholesky factors and log determinants; ``constant`` is the score if a class has no rows."""
    means: np.ndarray | None = None
    inverse_factors: np.ndarray | None = None
    log_dets: np.ndarray | None = None
    log_prior: float = 0.0
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = []
        for mean, inverse, log_det in zip(self.means, self.inverse_factors, self.log_dets, strict=True):
            z = (x - mean) @ inverse.T
            density.append(-0.5 * (z * z).sum(1) - 0.5 * log_det)
        return 1.0 / (1.0 + np.exp(-np.clip(density[1] - density[0] + self.log_prior, -500, 500)))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = len(FEATURES)
    sums = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        x = batch.column("x").flatten().to_numpy().reshape(-1, d)
        y = batch.column("y").to_numpy()
        for c in (0, 1):
            v = x[y == c]
            sums[c] += np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()])
    for c in (0, 1):
        yield pa.RecordBatch.from_pydict({"y": pa.array([c] * sums.shape[1], pa.int32()),
                                          "i": pa.array(range(sums.shape[1]), pa.int32()), "v": pa.array(sums[c])})


def fit(labelled: DataFrame, shrink_pooled: float = 0.02, shrink_diagonal: float = 0.02, ridge: float = 0.3) -> QdaModel:
    """Model from rows (x, y): y 0 or 1. The sums of all rows are added up by Spark."""
    d = len(FEATURES)
    summed = labelled.select("x", "y").mapInArrow(_moments, "y int, i int, v double").groupBy("y", "i").agg(F.sum("v").alias("v"))
    sums = np.zeros((2, 1 + d + d * d))
    for r in summed.collect():      # 2 * (1 + d + d * d) rows, whatever the input
        sums[r["y"], r["i"]] = r["v"]
    n = sums[:, 0]
    if n.min() < 2:
        return QdaModel(constant=float(n[1] / n.sum()) if n.sum() else 0.5)
    means = sums[:, 1:1 + d] / n[:, None]
    cov = np.stack([sums[c, 1 + d:].reshape(d, d) / n[c] - np.outer(means[c], means[c]) for c in (0, 1)])
    pooled = (cov * (n / n.sum())[:, None, None]).sum(0)
    factors, log_dets = [], []
    for c in (0, 1):
        s = (1 - shrink_pooled) * cov[c] + shrink_pooled * pooled
        s = (1 - shrink_diagonal) * s + shrink_diagonal * np.diag(np.diag(s)) + ridge * np.eye(d)
        factor = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(factor))
        log_dets.append(2 * np.log(np.diag(factor)).sum())
    return QdaModel(means, np.stack(factors), np.array(log_dets), float(np.log(n[1] / n[0])))


def score_statistics(stats: DataFrame, model: QdaModel) -> DataFrame:
    """Adds ``score`` (0 to 1) to rows of document_statistics."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    return stats.mapInArrow(scored, f"doc_id {dict(stats.dtypes)['doc_id']}, score double")


def train(stats: DataFrame, labels: DataFrame, label_col: str = "quality") -> QdaModel:
    """Model from the labelled rows that are not held out."""
    modulus, rest = HELD_OUT
    y = (labels.select(F.col("doc_id").alias("label_id"), F.col(label_col).cast("int").alias("y"))
               .where(F.col("y").isin(0, 1) & (crc_mod(F.col("label_id"), modulus) != rest)))
    return fit(stats.join(y, stats["doc_id"] == y["label_id"]))


def op1_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    stats = materialise(document_statistics(docs), "quality")
    scored = score_statistics(stats, train(stats, labels))
    held = F.coalesce(crc_mod(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1], F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, that the classifier accepts. The statistics are computed beside the
    rows, so that no join has to carry texts."""
    stats = materialise(document_statistics(docs), "quality")
    model = train(stats, labels)

    def accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                good = model.score(statistics(*buffer_of(part.column("text")))) >= THRESHOLD
                yield part.filter(pa.array(good))

    return docs.mapInArrow(accepted, docs.schema)
