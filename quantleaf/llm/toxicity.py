"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier.

1. Terms (words and their first 4, 5 and 6 letters) that labelled toxic documents use more often than
   clean ones form a lexicon. It is dealt to lexicon voters, terms with the same first letters
   to the same voter; pattern voters look for shouting, threats, insults and the like.
2. A generative model of the votes, fitted by EM, estimates how often each voter fires on either class, and the
   correlation of voters within a class; correlated voters share their weight. The noisy labels enter only as
   pseudo-counts of the rates. Its posterior is a soft label.
3. A logistic regression on the terms and patterns is fitted to the soft labels; it scores all documents.

Fitting uses a bounded sample: at most ``max_rows`` labelled documents, the first in order of a hash of the
id. All terms of the sample that pass the tests are features of the model. Scoring reads every whole text once, without a shuffle.

Defined results: a null or empty text has no terms and gets the score of the bias alone. Null labels and
labels other than 0 and 1 are not used; without toxic labelled rows there is no lexicon and every score is
the share of toxic rows (0 without labels). Null ids are scored and count as not held out. Repeated rows are
each scored. An empty table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, materialise, text_slices

THRESHOLD = 0.7
HELD_OUT = (3, 1)
MAX_ROWS = 50_000
STEMS = (4, 5, 6)
LEXICON_VOTERS = 64

_TOKEN = re.compile(r"\w+")
#: (words of which one must occur, pattern on the lower-cased text)
PATTERNS = (
    (None, re.compile(r"(?:!\s*){3,}")),
    ({"you", "u"}, re.compile(r"\b(?:you|u)\s+(?:are|re|r)\s+(?:an?|such|so|all)\b")),
    ({"kill", "hurt", "hang", "shoot"}, re.compile(r"\b(?:kill|hurt|hang|shoot)\s+(?:you|yourself|them|her|him)\b")),
    ({"hate", "despise"}, re.compile(r"\b(?:hate|despise)\s+(?:you|them|those|these)\b")),
    ({"shut", "piss", "hell"}, re.compile(r"\b(?:shut\s+up|piss\s+off|go\s+to\s+hell)\b")),
)


def words_of(text: str | None) -> set[str]:
    return set(_TOKEN.findall((text or "").lower()))


def stems_of(words) -> set[str]:
    """First letters of longer words, marked by a star."""
    return {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


class Lexicon:
    """Terms numbered from 0, patterns after them; ``hits`` finds those of a text."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.index = {t: i for i, t in enumerate(terms)}
        self.heads = {t.rstrip("*")[:STEMS[0]] for t in terms}
        self.size = len(terms) + len(PATTERNS)

    def hits(self, text: str | None) -> list[int]:
        if not text:
            return []
        head, heads, index = STEMS[0], self.heads, self.index
        text = text.lower()
        words = set(_TOKEN.findall(text))
        found = [w for w in words if w[:head] in heads]
        out = {index[t] for t in (*found, *stems_of(found)) if t in index}
        for k, (needed, pattern) in enumerate(PATTERNS):
            if (not words.isdisjoint(needed) if needed else "!" in text) and pattern.search(text):
                out.add(len(self.terms) + k)
        return sorted(out)

    def voter_of(self) -> np.ndarray:
        """Voter of each term and pattern: the terms by their first letters, which share the voters where they are more."""
        place = {h: k % LEXICON_VOTERS for k, h in enumerate(sorted(self.heads))}
        return np.array([place[t.rstrip("*")[:STEMS[0]]] for t in self.terms]
                        + [LEXICON_VOTERS + k for k in range(len(PATTERNS))], dtype=np.int64)


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, y, text) of at most ``max_rows`` labelled documents that are not held out."""
    modulus, rest = HELD_OUT
    y = (labels.select(F.col("doc_id").alias("label_id"), F.col(label_col).cast("int").alias("y"))
               .where(F.col("y").isin(0, 1) & (crc_mod(F.col("label_id"), modulus) != rest))
               .orderBy(F.xxhash64("label_id"), "label_id", "y").limit(max_rows))
    # Bounded: max_rows pairs of an id and a label.
    texts = docs.select("doc_id", "text")
    rows = texts.join(F.broadcast(y), texts["doc_id"] == y["label_id"]).select("doc_id", "y", "text")
    # A text counts once for each label: groups of copies would make their words look significant.
    return (rows.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).groupBy("h", "y")
                .agg(F.min_by(F.struct("doc_id", "text"), "doc_id").alias("r")).select("r.doc_id", "y", "r.text"))


def _counter(of, schema: str):
    """mapInArrow function: counts of ``of(text)`` over the rows of a task, as (term, n)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(of(text))
        if counts:
            yield pa.RecordBatch.from_pydict({"term": list(counts), "n": pa.array(counts.values(), pa.int64())})
    return run


def learn_lexicon(rows: DataFrame, min_docs: int = 4, min_log_odds: float = 2.5, min_ratio: float = 24.0) -> Lexicon:
    """All terms of toxic rows that are more frequent there than in clean rows, by a likelihood ratio statistic of
    at least ``min_ratio`` (among very many candidates, chance reaches about twice the log of their number).
    ``rows``: doc_id, y, text, bounded. Only the terms that pass come to the driver: they are the model."""
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(1):
        return Lexicon([])
    n1, n0 = n[1], n.get(0, 0)

    def terms(text):
        words = words_of(text)
        return words | stems_of(words)

    def counted(y: int) -> DataFrame:
        return (rows.where(F.col("y") == y).select("text").mapInArrow(_counter(terms, ""), "term string, n long")
                    .groupBy("term").agg(F.sum("n").alias(f"k{y}")))

    both = counted(1).where(F.col("k1") >= min(min_docs, n1)).join(counted(0), "term", "left").fillna(0, "k0")
    odds = F.log((F.col("k1") + 0.5) / (n1 + 1.0)) - F.log((F.col("k0") + 0.5) / (n0 + 1.0))
    passing = both.where(odds >= min_log_odds).collect()
    return Lexicon(sorted(r["term"] for r in passing if likelihood_ratio(r["k1"], n1, r["k0"], n0) >= min_ratio))


def likelihood_ratio(k1: int, n1: int, k0: int, n0: int) -> float:
    """G statistic of k1 of n1 against k0 of n0."""
    def part(k, n, p):
        return (k * np.log(k / (n * p)) if k else 0.0) + ((n - k) * np.log((n - k) / (n * (1 - p))) if n > k else 0.0)

    p = (k1 + k0) / (n1 + n0)
    return 2.0 * float(part(k1, n1, p) + part(k0, n0, p))


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 40, anchor: float = 5.0) -> np.ndarray:
    """P(toxic) of each row of 0/1 votes (rows x voters).

    A voter that does not fire abstains; a last voter, added here, says clean where none fires. EM estimates how often
    each voter fires in either class; the labels, which carry noise, only anchor these rates, as ``anchor`` pseudo-counts each.
    Half-way, the correlations of the voters' residuals within the classes are estimated; from then on the voters that
    fire on a row share their weight as far as they are correlated.
    """
    votes = np.column_stack([votes, ~(votes > 0).any(1)]).astype(np.float64)
    n, k = votes.shape
    share = min(max(float(labels.mean()), 1e-3), 0.5)
    correlation, p = np.eye(k), labels.astype(np.float64)
    for step in range(rounds):
        q = p + anchor * labels
        rest = 1 + anchor - q
        a = np.clip((q @ votes + 0.1) / (q.sum() + 1), 1e-5, 0.999)
        b = np.clip((rest @ votes + 0.1) / (rest.sum() + 1), 1e-5, 0.999)
        if step == rounds // 2:
            residual = votes - (np.outer(p, a) + np.outer(1 - p, b))
            deviation = np.sqrt((residual ** 2).mean(0)) + 1e-9
            correlation = (residual.T @ residual) / n / np.outer(deviation, deviation)
            correlation[correlation < 0.1] = 0
            np.fill_diagonal(correlation, 1)
        shared = np.maximum(votes @ correlation, 1)       # how many like votes the row has, for each voter
        odds = np.log(share / (1 - share)) + (votes / shared) @ np.log(a / b)
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return p


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weights[self.lexicon.hits(text)].sum())
        return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def fit_linear(hits: list[tuple[int, ...]], target: np.ndarray, size: int, rounds: int = 15, l2: float = 0.1) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of present features with soft targets, by Newton steps.

    Rows with the same set are merged. A step is found by conjugate gradients from products with the Hessian, so memory
    grows with the features that occur and not with the square of their number.
    """
    place: dict[tuple[int, ...], int] = {}
    group = np.array([place.setdefault(tuple(h), len(place)) for h in hits], np.int64)
    count = np.bincount(group, minlength=len(place)).astype(np.float64)
    mean = np.bincount(group, weights=target, minlength=len(place)) / np.maximum(count, 1)
    lengths = np.fromiter((len(h) for h in place), np.int64, len(place))
    row = np.repeat(np.arange(len(place)), lengths)
    feature = np.fromiter((k for h in place for k in h), np.int64, int(lengths.sum()))

    def forward(w: np.ndarray) -> np.ndarray:           # rows by weights; the last weight is the bias
        return np.bincount(row, w[feature], len(place)) + w[size]

    def back(v: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(feature, v[row], size), v.sum())

    w = np.zeros(size + 1)
    w[size] = np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3))
    penalty = np.append(np.full(size, l2), 1e-3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(forward(w), -30, 30)))
        grad = penalty * w * (np.arange(size + 1) < size) + back(count * (p - mean))
        weight = count * np.maximum(p * (1 - p), 1e-4)
        scale = penalty + back(weight)                  # the Hessian's diagonal preconditions
        step, rest = np.zeros(size + 1), grad.copy()
        z = rest / scale
        direction, size_z = z.copy(), rest @ z
        for _ in range(4 * (size + 1)):
            if rest @ rest <= 1e-20 * max(1.0, grad @ grad):
                break
            image = penalty * direction + back(weight * forward(direction))
            a = size_z / (direction @ image)
            step, rest = step + a * direction, rest - a * image
            z = rest / scale
            following = rest @ z
            direction, size_z = z + following / size_z * direction, following
        w -= step * min(1.0, 4.0 / (np.abs(step).max() + 1e-9))
    return w[:size], float(w[size])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> ToxicityModel:
    rows = materialise(training_rows(docs, labels, max_rows=max_rows), "toxicity")
    lexicon = learn_lexicon(rows)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lexicon.hits(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.list_(pa.int32()))], ["y", "hits"])

    # At most max_rows rows of term numbers: the bounded sample that the classifier is fitted on.
    sample = rows.select("y", "text").mapInArrow(hits, "y int, hits array<int>").toPandas()
    if not len(sample):
        return ToxicityModel(lexicon, np.zeros(lexicon.size), -30.0)
    share = float(sample["y"].mean())
    if not lexicon.terms:
        return ToxicityModel(lexicon, np.zeros(lexicon.size), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    sets = [tuple(int(k) for k in h) for h in sample["hits"]]
    voter = lexicon.voter_of()
    votes = np.zeros((len(sets), LEXICON_VOTERS + len(PATTERNS)))
    for i, h in enumerate(sets):
        votes[i, voter[list(h)]] = 1
    return ToxicityModel(lexicon, *fit_linear(sets, label_model(votes, sample["y"].to_numpy()), lexicon.size))


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                scores = [model.score(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def op6_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held = F.coalesce(crc_mod(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1], F.lit(False))
    return score_documents(docs, fit(docs, labels)).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, that the classifier does not find toxic."""
    model = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                yield part.filter(pa.array([model.score(t) < THRESHOLD for t in part.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
