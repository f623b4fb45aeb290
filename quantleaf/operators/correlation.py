"""Pairwise Pearson correlation of daily returns over common dates.

The reference forms every (ticker, ticker) pair on every date with a self-join
and sums six moments per pair. That join emits D·T(T-1)/2 rows and puts all
pairs of a busy date into one task. Here the six sums are entries of Gram
matrices (masked X'X products over the date axis), computed block-wise:

1. tickers are hashed into ``B`` blocks and dates cut into chunks;
2. each return row is sent to the B block-pairs its block takes part in;
3. ``applyInPandas`` per (block pair, date chunk) builds two small dense
   date×ticker matrices and multiplies them (exact integer arithmetic on
   returns scaled to integers), emitting one partial row per ticker pair;
4. a ``groupBy(stock_1, stock_2)`` sums the partials in DECIMAL(38,0) and the
   coefficient is formed once per pair.

Group size is bounded by (tickers per block) × (days per chunk) whatever the
data volume; the shuffle carries one partial row per pair and chunk instead of
one row per pair and date. Sums are exact, so a constant series gives a zero
variance and a NULL coefficient, as the reference's decimal arithmetic does.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantleaf.config import EngineConfig
from quantleaf.functions import exprs as X

SCALE = 10_000  # returns are DECIMAL(18,4): x = r * 10^4 is an exact integer
MOMENTS = _MOMENTS = ["n", "sx", "sy", "sxy", "sxx", "syy"]
# Each moment travels as two int64 limbs, v = hi * 2^32 + lo with 0 <= lo < 2^32,
# so partial sums of any size stay exact on their way to the DECIMAL(38,0) totals.
_LIMB = 2 ** 32
_PARTIAL_SCHEMA = "chunk long, stock_1 string, stock_2 string, " + ", ".join(
    f"{m}_hi long, {m}_lo long" for m in _MOMENTS)
_EXACT_F64 = 2 ** 53

# The grouped-map function and its helpers travel with the task (pickled by value),
# so Python workers need only numpy/pandas, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _side(rows: pd.DataFrame, dates: pd.Index):
    names = np.array(sorted(rows["ticker"].unique()), dtype=object)
    idx = pd.Index(names)
    xs = np.zeros((len(dates), len(names)), dtype=np.int64)
    ms = np.zeros((len(dates), len(names)), dtype=np.int64)
    r = dates.get_indexer(rows["trade_date"])
    c = idx.get_indexer(rows["ticker"])
    xs[r, c] = rows["x"].to_numpy(dtype=np.int64)
    ms[r, c] = 1
    return names, xs, ms


def _products(xa, ma, xb, mb):
    """Exact (n, Σx, Σy, Σxy, Σx², Σy²) matrices over the date axis.

    Integer-valued float64 matmuls are exact while every partial sum stays below
    2^53; larger magnitudes fall back to Python integers (object arrays)."""
    mx = int(max(np.abs(xa).max(initial=0), np.abs(xb).max(initial=0), 1))
    if mx * mx * xa.shape[0] < _EXACT_F64:
        fa, fma, fb, fmb = (m.astype(np.float64) for m in (xa, ma, xb, mb))
        out = [fma.T @ fmb, fa.T @ fmb, fma.T @ fb, fa.T @ fb, (fa * fa).T @ fmb, fma.T @ (fb * fb)]
        return [np.rint(o).astype(np.int64) for o in out]
    a, m1, b, m2 = (m.astype(object) for m in (xa, ma, xb, mb))
    return [m1.T @ m2, a.T @ m2, m1.T @ b, a.T @ b, (a * a).T @ m2, m1.T @ (b * b)]


def _limbs(v: np.ndarray):
    if v.dtype == object:
        return (np.array([x // _LIMB for x in v], dtype=np.int64),
                np.array([x % _LIMB for x in v], dtype=np.int64))
    return v // _LIMB, v % _LIMB


def _gram_partials(pdf: pd.DataFrame) -> pd.DataFrame:
    lo, hi = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
    dates = pd.Index(pd.unique(pdf["trade_date"]))
    a_rows = pdf[pdf["blk"] == lo]
    na, xa, ma = _side(a_rows, dates)
    nb, xb, mb = (na, xa, ma) if lo == hi else _side(pdf[pdf["blk"] == hi], dates)
    n, sx, sy, sxy, sxx, syy = _products(xa, ma, xb, mb)
    keep = np.asarray(n > 0, dtype=bool)
    if lo == hi:
        keep &= np.triu(np.ones_like(keep, dtype=bool), k=1)  # names sorted: i < j ⇔ name_i < name_j
    i, j = np.nonzero(keep)
    s1, s2 = na[i], nb[j]
    flip = np.asarray(s1 > s2, dtype=bool)
    cols = {"chunk": int(pdf["chunk"].iloc[0]), "stock_1": np.where(flip, s2, s1), "stock_2": np.where(flip, s1, s2)}
    picked = {
        "n": n[i, j], "sxy": sxy[i, j],
        "sx": np.where(flip, sy[i, j], sx[i, j]), "sy": np.where(flip, sx[i, j], sy[i, j]),
        "sxx": np.where(flip, syy[i, j], sxx[i, j]), "syy": np.where(flip, sxx[i, j], syy[i, j]),
    }
    for m in _MOMENTS:
        cols[f"{m}_hi"], cols[f"{m}_lo"] = _limbs(np.asarray(picked[m]))
    return pd.DataFrame(cols)


def _partials(returns: DataFrame, blocks: int, chunk_days: int) -> DataFrame:
    r = returns.select(
        "ticker", "trade_date",
        (F.col("daily_return_pct") * SCALE).cast("long").alias("x"),
        F.pmod(F.xxhash64("ticker"), F.lit(blocks)).cast("int").alias("blk"),
        F.floor(F.unix_date("trade_date") / chunk_days).cast("long").alias("chunk"))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    fanned = (r.select("*", other)
              .select("ticker", "trade_date", "x", "blk", "chunk",
                      F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi")))
    return fanned.groupBy("lo", "hi", "chunk").applyInPandas(_gram_partials, _PARTIAL_SCHEMA)


def _whole(m: str):
    dec = "decimal(38,0)"
    return (F.col(f"{m}_hi").cast(dec) * F.lit(_LIMB).cast(dec) + F.col(f"{m}_lo")).cast(dec).alias(m)


def chunk_moments(returns: DataFrame, blocks: int, chunk_days: int) -> DataFrame:
    """chunk, stock_1, stock_2 and the sums of ``pair_moments`` over each chunk of days by itself (a pair lies in one block pair, so
    each has one row per chunk)."""
    return _partials(returns, blocks, chunk_days).select("chunk", "stock_1", "stock_2", *[_whole(m) for m in _MOMENTS])


def pair_moments(returns: DataFrame, blocks: int, chunk_days: int) -> DataFrame:
    """Exact per-pair sums over common dates: n, Σx, Σy, Σxy, Σx², Σy² (x = return · 10^4).

    ``returns``: (ticker, trade_date, daily_return_pct) with non-NULL returns,
    at most one row per (ticker, trade_date).
    """
    partials = _partials(returns, blocks, chunk_days)
    dec = "decimal(38,0)"
    sums = [F.sum(F.col(f"{m}_{p}").cast(dec)).alias(f"{m}_{p}") for m in _MOMENTS for p in ("hi", "lo")]
    return (partials.groupBy("stock_1", "stock_2").agg(*sums)
            .select("stock_1", "stock_2", *[_whole(m) for m in _MOMENTS]))


def coefficient(m: DataFrame) -> DataFrame:
    """Pearson r from exact moments; NULL when either side has zero variance."""
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    num = n * F.col("sxy") - sx * sy
    va = n * F.col("sxx") - sx * sx
    vb = n * F.col("syy") - sy * sy
    den = F.sqrt(va.cast("double") * vb.cast("double"))
    raw = num.cast("double") / F.nullif(den, F.lit(0.0))
    return m.withColumn("_raw", raw).withColumn("correlation_coefficient", X.to_dec("_raw"))


def auto_blocks(instruments: DataFrame, target_tickers_per_block: int = 512) -> int:
    """Block count from the instrument dimension (a small table, not the return history).
    It only sizes the work: results do not depend on it."""
    n = instruments.select("ticker").distinct().count()
    return max(1, math.ceil(n / target_tickers_per_block))


def correlation_matrix(prices: DataFrame, companies: DataFrame, cfg: EngineConfig) -> DataFrame:
    """M11 gold_correlation_matrix."""
    rets = prices.where(F.col("daily_return_pct").isNotNull()).select("ticker", "trade_date", "daily_return_pct")
    blocks = cfg.corr_blocks if cfg.corr_blocks > 0 else auto_blocks(companies)
    return matrix_of(pair_moments(rets, blocks, cfg.corr_chunk_days), companies, cfg)


def matrix_of(moments: DataFrame, companies: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The correlation matrix from exact moments of all pairs."""
    c = coefficient(moments.where(F.col("n") > cfg.min_obs))
    how = "inner" if cfg.sp else "left"
    c1 = companies.select(F.col("ticker").alias("stock_1"), F.col("category").alias("stock_1_category"),
                          F.col("region").alias("stock_1_region"))
    c2 = companies.select(F.col("ticker").alias("stock_2"), F.col("category").alias("stock_2_category"),
                          F.col("region").alias("stock_2_region"))
    j = c.join(c1, "stock_1", how).join(c2, "stock_2", how)
    # dbt buckets the coefficient rounded to 4 dp; the procedures bucket the raw value
    # and let a NULL coefficient fall through to 'Negative'.
    label = (X.correlation_label("_raw", "Negative") if cfg.sp
             else X.correlation_label("correlation_coefficient", cfg.null_relationship))
    return j.select("stock_1", "stock_2", "stock_1_category", "stock_2_category",
                    "stock_1_region", "stock_2_region", "correlation_coefficient", label.alias("relationship"))
