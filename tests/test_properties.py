"""Property tests: the skew-safe primitives equal their plain single-partition definitions."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from quantleaf.operators.ranking import rank_by
from quantleaf.operators.windows import segmented_lag

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

series = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 400), st.integers(-50, 50)),
    min_size=1, max_size=120)


@SETTINGS
@given(rows=series, bucket=st.integers(1, 60))
def test_segmented_lag_is_lag(spark, rows, bucket):
    start = dt.date(2020, 1, 1)
    uniq = {(k, d): v for k, d, v in rows}          # one row per (key, date)
    data = [(k, start + dt.timedelta(days=d), float(v)) for (k, d), v in uniq.items()]
    df = spark.createDataFrame(data, "k string, d date, v double")
    got = sorted(segmented_lag(df, ["k"], "d", ["v"], bucket).select("k", "d", "prev_v").collect())
    want = sorted(df.select("k", "d", F.lag("v").over(Window.partitionBy("k").orderBy("d")).alias("prev_v"))
                  .collect())
    assert got == want


@SETTINGS
@given(vals=st.lists(st.tuples(st.sampled_from(["x", "y"]), st.one_of(st.none(), st.integers(0, 9))),
                     min_size=1, max_size=80),
       desc=st.booleans(), buckets=st.integers(1, 9))
def test_rank_by_is_rank(spark, vals, desc, buckets):
    data = [(f"t{i}", g, None if v is None else float(v)) for i, (g, v) in enumerate(vals)]
    df = spark.createDataFrame(data, "id string, g string, v double")
    got = {r.id: r.rk for r in rank_by(df, "v", ["g"], descending=desc, out="rk", buckets=buckets).collect()}
    pdf = pd.DataFrame(data, columns=["id", "g", "v"])
    pdf["rk"] = pdf.groupby("g")["v"].rank(method="min", ascending=not desc)
    for i, rk in zip(pdf["id"], pdf["rk"]):
        assert got[i] == (None if pd.isna(rk) else int(rk))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), blocks=st.integers(1, 5), chunk=st.integers(1, 40))
def test_gram_correlation_is_self_join(spark, seed, blocks, chunk):
    from tests.test_correlation_ranking import PRICE_SCHEMA, brute_force, companies, random_returns
    from quantleaf.config import EngineConfig
    from quantleaf.operators.correlation import correlation_matrix
    tickers = [f"S{i}" for i in range(6)]
    rows = random_returns(seed, tickers, 25)
    df = spark.createDataFrame(rows, PRICE_SCHEMA)
    got = {(r.stock_1, r.stock_2): r.correlation_coefficient for r in
           correlation_matrix(df, companies(spark, tickers),
                              EngineConfig(corr_blocks=blocks, corr_chunk_days=chunk)).collect()}
    assert got == brute_force(rows)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 3), st.integers(0, 5),
                               st.integers(0, 1000), st.integers(-99, 99)), min_size=1, max_size=150))
def test_latest_by_key_is_last_by_order_tuple(spark, rows):
    from quantleaf.operators.windows import latest_by_key
    uniq = {(k, d, f, t): v for k, d, f, t, v in rows}          # the order tuple is unique per key
    data = [(k, d, f, t, v) for (k, d, f, t), v in uniq.items()]
    df = spark.createDataFrame(data, "k string, d int, fetch int, tie int, v int")
    got = {(r.k, r.d): r.v for r in latest_by_key(df, ["k", "d"], ["fetch", "tie"], ["v"]).collect()}
    pdf = pd.DataFrame(data, columns=["k", "d", "fetch", "tie", "v"]).sort_values(["fetch", "tie"])
    want = {key: g["v"].iloc[-1] for key, g in pdf.groupby(["k", "d"])}
    assert got == want
