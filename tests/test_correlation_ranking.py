"""Block-wise Gram correlation and distributed ranking against brute force."""

import datetime as dt
import math
import random
from decimal import Decimal as D

import pandas as pd

from quantleaf.config import EngineConfig
from quantleaf.operators.correlation import correlation_matrix, pair_moments
from quantleaf.operators.ranking import rank_by, top_by

PRICE_SCHEMA = "ticker string, trade_date date, daily_return_pct decimal(18,4)"


def brute_force(rows):
    """The reference's formula over an explicit self-join on date (Python ints, exact)."""
    by_date = {}
    for t, d, r in rows:
        if r is not None:
            by_date.setdefault(d, {})[t] = int(r * 10000)
    sums = {}
    for d, m in by_date.items():
        for a in m:
            for b in m:
                if a < b:
                    s = sums.setdefault((a, b), [0] * 6)
                    x, y = m[a], m[b]
                    for i, v in enumerate((1, x, y, x * y, x * x, y * y)):
                        s[i] += v
    out = {}
    for k, (n, sx, sy, sxy, sxx, syy) in sums.items():
        den = math.sqrt(float(n * sxx - sx * sx) * float(n * syy - sy * sy))
        c = None if den == 0 else float(n * sxy - sx * sy) / den
        out[k] = None if c is None else D(str(c)).quantize(D("0.0001"), rounding="ROUND_HALF_UP")
    return out


def random_returns(seed, tickers, days, scale=5.0):
    rnd = random.Random(seed)
    rows = []
    start = dt.date(2020, 1, 1)
    for t in tickers:
        for i in range(days):
            if rnd.random() < 0.8:
                r = None if rnd.random() < 0.05 else D(str(round(rnd.gauss(0, scale), 4)))
                rows.append((t, start + dt.timedelta(days=i), r))
    return rows


def companies(spark, tickers):
    return spark.createDataFrame([(t, t, "", "", "USD", f"C{i % 3}", f"R{i % 2}") for i, t in enumerate(tickers)],
                                 "ticker string, company_name string, country string, exchange string, "
                                 "currency string, category string, region string")


def test_gram_matches_self_join(spark):
    tickers = [f"T{i:02d}" for i in range(11)] + ["CONST"]
    rows = random_returns(1, tickers[:-1], 60)
    rows += [("CONST", dt.date(2020, 1, 1) + dt.timedelta(days=i), D("1.5000")) for i in range(60)]
    df = spark.createDataFrame(rows, PRICE_SCHEMA)
    cfg = EngineConfig(corr_blocks=3, corr_chunk_days=9)
    got = {(r.stock_1, r.stock_2): r for r in correlation_matrix(df, companies(spark, tickers), cfg).collect()}
    want = brute_force(rows)
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k].correlation_coefficient == v, k
    const = [r for k, r in got.items() if "CONST" in k]
    assert const and all(r.correlation_coefficient is None and r.relationship is None for r in const)


def test_gram_exact_for_huge_returns(spark):
    # magnitudes beyond 2^53 in the sums take the exact integer path
    tickers = ["A", "B", "C"]
    rows = random_returns(5, tickers, 40, scale=3e5)
    df = spark.createDataFrame(rows, PRICE_SCHEMA)
    got = {(r.stock_1, r.stock_2): r.correlation_coefficient
           for r in correlation_matrix(df, companies(spark, tickers), EngineConfig(corr_blocks=2)).collect()}
    assert got == brute_force(rows)


def test_pair_moments_blocks_agree(spark):
    rows = random_returns(9, [f"S{i}" for i in range(7)], 30)
    df = spark.createDataFrame(rows, PRICE_SCHEMA).where("daily_return_pct IS NOT NULL")
    a = sorted(tuple(r) for r in pair_moments(df, 1, 1000).collect())
    b = sorted(tuple(r) for r in pair_moments(df, 4, 5).collect())
    assert a == b


def test_min_obs(spark):
    rows = random_returns(2, ["A", "B", "C"], 20)
    df = spark.createDataFrame(rows, PRICE_SCHEMA)
    comp = companies(spark, ["A", "B", "C"])
    assert correlation_matrix(df, comp, EngineConfig(corr_blocks=1, min_obs=1000)).count() == 0


def test_rank_by_matches_sql_rank(spark):
    rnd = random.Random(4)
    rows = [(f"t{i}", rnd.choice(["x", "y", "z"]),
             None if rnd.random() < 0.1 else float(rnd.choice(range(25)))) for i in range(400)]
    df = spark.createDataFrame(rows, "ticker string, grp string, v double")
    got = {r.ticker: r.rk for r in rank_by(df, "v", ["grp"], descending=True, out="rk", buckets=8).collect()}
    pdf = pd.DataFrame(rows, columns=["ticker", "grp", "v"])
    pdf["rk"] = pdf.groupby("grp")["v"].rank(method="min", ascending=False)
    for t, rk in zip(pdf["ticker"], pdf["rk"]):
        assert got[t] == (None if pd.isna(rk) else int(rk))
    glob = {r.ticker: r.rk for r in rank_by(df, "v", None, descending=False, out="rk", buckets=5).collect()}
    pdf["g"] = pdf["v"].rank(method="min", ascending=True)
    for t, rk in zip(pdf["ticker"], pdf["g"]):
        assert glob[t] == (None if pd.isna(rk) else int(rk))


def test_top_by_keeps_ties(spark):
    df = spark.createDataFrame([("a", "g", 5.0), ("b", "g", 5.0), ("c", "g", 1.0), ("d", "h", None)],
                               "ticker string, grp string, v double")
    best = sorted(r.ticker for r in top_by(df, "v", ["grp"]).collect())
    assert best == ["a", "b"]
