"""Month states against the measures over rows for many ranges; stored pair moments against the product over all days."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quantleaf.config import EngineConfig
from quantleaf.operators import correlation as C
from quantleaf.operators import measures as M
from quantleaf.operators import period_states as PS
from quantleaf.plans import catalog, pair_store

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("states"))
    L = catalog.layers(spark, SF)
    catalog._daily(L).coalesce(1).sortWithinPartitions("trade_date").write.parquet(f"{folder}/daily")
    daily = spark.read.parquet(f"{folder}/daily")
    PS.month_states(daily).write.parquet(f"{folder}/states")
    return daily, spark.read.parquet(f"{folder}/states"), L.silver.companies


@pytest.mark.parametrize("start,end", [("1995-03-10", "1999-10-20"), ("1995-03-01", "1995-03-31"), ("1996-02-29", "1996-02-29"), ("1995-05-04", "1995-05-20"),
                                       ("1995-05-04", "1995-06-20"), ("1990-01-01", "2030-12-31"), ("1996-02-01", "1997-06-15"), ("1996-02-02", "1997-06-30")])
def test_ranges_equal_the_rows(stored, start, end):
    daily, states, companies = stored
    a, b = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    rows = M.slice_daily(daily, start=a, end=b)
    for grain in ("year", "month"):
        got = PS.period_returns(PS.of_range(states, daily, a, b), grain)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, M.period_returns(rows, grain).collect()))
    got = PS.category_volatility(PS.of_range(states, daily, a, b), companies)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, M.category_period_volatility(rows, companies).collect()))


def test_only_the_cut_months_are_read(spark, stored):
    daily, states, _ = stored
    df = PS.of_range(states, daily, dt.date(1995, 3, 10), dt.date(1999, 10, 20))
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    scans = [line for line in plan.splitlines() if line.startswith("PushedFilters")]
    assert any("trade_date,1995-04-01" in s and "trade_date,1999-09-30" in s for s in scans) and any("month,1995-04-01" in s for s in scans), scans
    from_rows = PS.of_range(states.limit(0), daily, dt.date(1995, 3, 10), dt.date(1999, 10, 20)).select("month").distinct().collect()
    assert {r.month for r in from_rows} == {dt.date(1995, 3, 1), dt.date(1999, 10, 1)}


def test_moments_of_one_chunk_are_recomputed(spark, tmp_dir):
    L = catalog.layers(spark, SF)
    prices, companies, cfg = L.silver.prices, L.silver.companies, EngineConfig(corr_chunk_days=200)
    target = os.path.join(tmp_dir, "moments")
    cut = dt.date(1997, 5, 5)
    first = pair_store.update(spark, prices.where(F.col("trade_date") < F.lit(cut)), companies, target, cfg)
    same = lambda v, p: (sorted(map(tuple, pair_store.correlation_matrix(v, companies, cfg).collect()))
                         == sorted(map(tuple, C.correlation_matrix(p, companies, cfg).collect())))
    assert same(first, prices.where(F.col("trade_date") < F.lit(cut)))
    day = prices.where(F.col("trade_date") <= F.lit(cut + dt.timedelta(days=3)))
    second = pair_store.update(spark, day, companies, target, cfg, [cut + dt.timedelta(days=k) for k in range(4)])
    moved = {n for n in second.names if first.places.get(n) != second.places[n]}
    assert moved == {f"moments/{pair_store.chunk_of(cut, cfg)}"} and len(second.names) >= 5
    assert same(second, day)
    n = pair_store.pair_count(second, day).first()
    assert n.complete == (n.pairs == n.expected_pairs)
    plan = pair_store.moments(second)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan
    none = pair_store.update(spark, prices.limit(0), companies, os.path.join(tmp_dir, "none"), cfg)
    assert pair_store.correlation_matrix(none, companies, cfg).collect() == []
