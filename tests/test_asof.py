"""General as-of join against pandas.merge_asof, hot keys, nulls, plan shape."""

import datetime as dt
import random
from dataclasses import replace

import pandas as pd
import pytest

from quantleaf.operators.asof import asof_join
from quantleaf.plans import catalog
from quantleaf.plans import refresh as P

SF = "/root/testdata/sf0.001"
D0 = dt.date(2020, 1, 1)


def day(k):
    return D0 + dt.timedelta(days=k)


def tables(seed, n_left=300, n_right=60):
    rnd = random.Random(seed)
    right = {(rnd.choice("abc"), day(rnd.randint(0, 900))): rnd.randint(0, 99) for _ in range(n_right)}
    right = [(k, d, v if v % 7 else None, str(v)) for (k, d), v in right.items()]
    left = [(i % (n_left - 20), rnd.choice(["a", "a", "a", "b", "z", None]), day(rnd.randint(-50, 1000)) if rnd.random() > 0.02 else None) for i in range(n_left)]
    return left, right


def brute_force(left, right, tolerance):
    out = []
    for i, k, d in left:
        found = max(((r[1], r) for r in right if k is not None and d is not None and r[0] == k and r[1] <= d), default=None, key=lambda f: f[0])
        if found and tolerance is not None and (d - found[0]).days > tolerance:
            found = None
        out.append((i, k, d, *(found[1][2:] if found else (None, None)), found[0] if found else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("tolerance", [None, 0, 40])
@pytest.mark.parametrize("bucket,salts", [(7, 1), (90, 3), (5000, 4)])
def test_equals_brute_force(spark, tolerance, bucket, salts):
    left, right = tables(bucket + salts)
    df = asof_join(spark.createDataFrame(left, "i int, k string, d date"), spark.createDataFrame(right, "k string, d date, v int, t string"),
                   ["k"], "d", ["v", "t"], bucket, tolerance, "quoted", salts)
    assert df.columns == ["i", "k", "d", "v", "t", "quoted"]
    assert sorted(map(str, map(tuple, df.collect()))) == brute_force(left, right, tolerance)


def test_equals_merge_asof(spark):
    left, right = tables(5, 500, 200)
    a = pd.DataFrame([r for r in left if r[1] and r[2]], columns=["i", "k", "d"])
    b = pd.DataFrame(right, columns=["k", "d", "v", "t"])
    a["d"], b["d"] = pd.to_datetime(a["d"]), pd.to_datetime(b["d"])
    want = pd.merge_asof(a.sort_values("d"), b.sort_values("d"), on="d", by="k")
    got = asof_join(spark.createDataFrame(left, "i int, k string, d date"), spark.createDataFrame(right, "k string, d date, v int, t string"),
                    ["k"], "d", ["t"], 30, salts=2).where("k IS NOT NULL AND d IS NOT NULL").collect()
    key = lambda rows: sorted(rows, key=str)
    assert key(same_list(got)) == key(same_list(want[["i", "k", "d", "t"]].itertuples(index=False)))


def same_list(rows):
    return [(i, k, str(d)[:10], None if t is None or t != t else t) for i, k, d, t in rows]


def test_empty_sides(spark):
    left, right = tables(1)
    a, b = spark.createDataFrame(left, "i int, k string, d date"), spark.createDataFrame(right, "k string, d date, v int, t string")
    assert asof_join(a.limit(0), b, ["k"], "d", ["v"]).collect() == []
    assert {r.v for r in asof_join(a, b.limit(0), ["k"], "d", ["v"]).collect()} == {None}


def test_plan_has_no_grid_and_splits_the_key(spark):
    L = catalog.layers(spark, SF)
    rows = L.silver.prices.select("ticker", "trade_date").withColumnRenamed("ticker", "forex_pair")
    quotes = L.silver.forex.withColumnRenamed("currency_pair", "forex_pair")
    plan = asof_join(rows, quotes, ["forex_pair"], "trade_date", ["close_rate"], salts=4)._jdf.queryExecution().executedPlan().toString()
    assert "sequence(cast(_s" not in plan and "Join" not in plan
    assert "forex_pair" in plan and "_bucket" in plan and "_salt" in plan.split("Window")[1]


def test_daily_returns_equal_the_dense_grid(spark):
    from quantleaf.operators import gold as G
    L = catalog.layers(spark, SF)
    cfg = replace(L.cfg, fx_policy="asof")
    s = L.silver
    last = s.prices.agg({"trade_date": "max"}).first()[0]
    dense = G.daily_inr_returns(s.prices, s.forex, s.companies, s.currency_map, cfg, G.densify_fx(s.forex, last))
    got = P.daily_inr(P.gold_inputs(s, cfg))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, dense.collect()), key=str)
