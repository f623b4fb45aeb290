"""Silver cleaning (M1–M4, M29–M31) on literal frames, and the segmented windows
against plain single-partition windows on random data."""

import datetime as dt
import random
from decimal import Decimal as D

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from quantleaf import schemas
from quantleaf.operators import silver as S
from quantleaf.operators.windows import latest_by_key, segmented_ffill, segmented_lag

T0 = dt.datetime(2025, 1, 1, 12, 0)


def bronze(spark, rows):
    """rows: (ticker, date, close, currency, fetched_at)"""
    full = [(t, d, c, c, c, c, 10, "X", cur, f) for t, d, c, cur, f in rows]
    return spark.createDataFrame(full, schemas.BRONZE_PRICES)


def clean(spark, rows, **kw):
    return {(r.ticker, r.trade_date): r for r in
            S.clean_prices(bronze(spark, rows), ["api_fetched_at"], {"GBp": 100}, **kw).collect()}


def test_latest_fetch_wins_and_first_return_null(spark):
    d1, d2 = dt.date(2025, 1, 2), dt.date(2025, 1, 3)
    out = clean(spark, [
        ("A", d1, D("10.0000"), "USD", T0),
        ("A", d1, D("11.0000"), "USD", T0 + dt.timedelta(hours=1)),   # later fetch wins
        ("A", d2, D("12.1000"), "USD", T0),
    ])
    assert out[("A", d1)].close_price == D("11.0000")
    assert out[("A", d1)].daily_return_pct is None
    assert out[("A", d2)].daily_return_pct == D("10.0000")
    assert all(r.is_valid for r in out.values())


def test_pence_converted_case_sensitive(spark):
    d1 = dt.date(2025, 1, 2)
    out = clean(spark, [("L", d1, D("600.0000"), "GBp", T0), ("P", d1, D("600.0000"), "GBP", T0)])
    assert out[("L", d1)].close_price == D("6.0000")
    assert out[("L", d1)].open_price == D("6.0000")
    assert out[("P", d1)].close_price == D("600.0000")


def test_return_uses_unrounded_converted_close(spark):
    d1, d2 = dt.date(2025, 1, 2), dt.date(2025, 1, 3)
    out = clean(spark, [("L", d1, D("600.0050"), "GBp", T0), ("L", d2, D("700.0000"), "GBp", T0)])
    assert out[("L", d1)].close_price == D("6.0001")     # 6.000050 rounded half-up
    # (7 - 6.00005) / 6.00005 * 100, not computed from the rounded 6.0001
    assert out[("L", d2)].daily_return_pct == D("16.6657")


def test_zero_previous_close_gives_null(spark):
    d1, d2 = dt.date(2025, 1, 2), dt.date(2025, 1, 3)
    out = clean(spark, [("A", d1, D("0"), "USD", T0), ("A", d2, D("5"), "USD", T0)])
    assert out[("A", d2)].daily_return_pct is None


def test_return_across_bucket_boundary(spark):
    # 3-day buckets: the lag must reach back over empty buckets to the last earlier row
    ds = [dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 20), dt.date(2025, 3, 1)]
    out = clean(spark, [("A", d, D(str(10 + i)), "USD", T0) for i, d in enumerate(ds)], bucket_days=3)
    assert out[("A", ds[2])].daily_return_pct == D("9.0909")   # 12 vs 11
    assert out[("A", ds[3])].daily_return_pct == D("8.3333")   # 13 vs 12


def test_segmented_lag_matches_plain_lag(spark):
    rnd = random.Random(7)
    rows = []
    for t in ["A", "B", "C"]:
        d = dt.date(2020, 1, 1)
        for _ in range(300):
            d += dt.timedelta(days=rnd.choice([1, 1, 2, 3, 17, 40]))
            rows.append((t, d, rnd.random()))
    df = spark.createDataFrame(rows, "k string, d date, v double")
    got = segmented_lag(df, ["k"], "d", ["v"], bucket_days=11).select("k", "d", "prev_v")
    want = df.select("k", "d", F.lag("v").over(Window.partitionBy("k").orderBy("d")).alias("prev_v"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_segmented_ffill_matches_pandas(spark):
    rnd = random.Random(3)
    rows = []
    for t in ["A", "B"]:
        d = dt.date(2020, 1, 1)
        for _ in range(200):
            d += dt.timedelta(days=rnd.choice([1, 2, 30]))
            rows.append((t, d, rnd.random() if rnd.random() < 0.3 else None))
    df = spark.createDataFrame(rows, "k string, d date, v double")
    got = segmented_ffill(df, ["k"], "d", ["v"], bucket_days=7, flag_col="ok").toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "d", "v"]).sort_values(["k", "d"])
    pdf["f"] = pdf.groupby("k")["v"].ffill()
    m = got.merge(pdf, on=["k", "d"])
    assert len(m) == len(rows)
    assert ((m["v_x"].isna() & m["f"].isna()) | (m["v_x"] == m["f"])).all()
    imputed = m["v_y"].isna() & m["f"].notna()
    assert (m["ok"] == ~imputed).all()


def test_latest_by_key_hot_key(spark):
    # one key with many copies: the partial aggregate keeps one row per key per task
    rows = [("HOT", i, float(i)) for i in range(5000)] + [("COLD", 1, 1.0)]
    df = spark.createDataFrame(rows, "k string, seq int, v double").repartition(8)
    out = {r.k: r.v for r in latest_by_key(df, ["k"], ["seq"], ["v"]).collect()}
    assert out == {"HOT": 4999.0, "COLD": 1.0}


def test_clean_forex_and_fundamentals(spark):
    fx = spark.createDataFrame(
        [("USD/INR", dt.date(2025, 1, 2), None, None, None, D("80.000000"), T0),
         ("USD/INR", dt.date(2025, 1, 2), None, None, None, D("82.000000"), T0 + dt.timedelta(1)),
         ("USD/INR", dt.date(2025, 1, 3), None, None, None, D("84.050000"), T0)], schemas.BRONZE_FOREX)
    out = {r.trade_date: r for r in S.clean_forex(fx, ["api_fetched_at"]).collect()}
    assert out[dt.date(2025, 1, 2)].close_rate == D("82.000000")
    assert out[dt.date(2025, 1, 3)].daily_change_pct == D("2.500000")
    fund = spark.createDataFrame(
        [("A", None, 1, D(1), D(1), None, None, None, None, D(1), D(1), D(1), 5, T0),
         ("A", None, 2, D(2), D(2), None, None, None, None, D(2), D(2), D(2), 5, T0 + dt.timedelta(1))],
        schemas.BRONZE_FUNDAMENTALS)
    r = S.clean_fundamentals(fund, ["api_fetched_at"]).collect()
    assert len(r) == 1 and r[0].market_cap == 2 and r[0].revenue is None


def test_calendar(spark):
    cal = {r.date_key: r for r in S.calendar(spark, dt.date(2023, 1, 1), dt.date(2023, 12, 31)).collect()}
    assert len(cal) == 365
    r = cal[dt.date(2023, 1, 1)]
    assert (r.day_of_week, r.day_name, r.week_number, r.quarter_name, r.is_weekend, r.is_trading_day) == \
        (1, "Sunday", 1, "Q1", True, False)
    assert cal[dt.date(2023, 1, 2)].is_trading_day


def test_normalize_pairs_inverts_base_first(spark):
    fx = spark.createDataFrame([("INR/USD", dt.date(2025, 1, 2), D("0.012500")),
                                ("USD/INR", dt.date(2025, 1, 2), D("80.000000"))],
                               "currency_pair string, trade_date date, close_rate decimal(18,6)")
    out = {(r.currency_pair, r.was_inverted): r.close_rate for r in S.normalize_pairs(fx, "INR").collect()}
    assert out == {("USD/INR", True): D("80.000000"), ("USD/INR", False): D("80.000000")}


def test_calendar_holidays(spark):
    hol = spark.createDataFrame([(dt.date(2023, 1, 2),)], "date_key date")
    cal = {r.date_key: r for r in S.calendar(spark, dt.date(2023, 1, 1), dt.date(2023, 1, 7), hol).collect()}
    assert len(cal) == 7
    assert not cal[dt.date(2023, 1, 2)].is_trading_day and cal[dt.date(2023, 1, 3)].is_trading_day
    assert not cal[dt.date(2023, 1, 2)].is_weekend


def test_minor_units_by_ticker(spark):
    d1 = dt.date(2025, 1, 2)
    df = bronze(spark, [("RR", d1, D("600.0000"), "GBP", T0), ("XOM", d1, D("600.0000"), "USD", T0)])
    out = {r.ticker: r.close_price for r in
           S.clean_prices(df, ["api_fetched_at"], {"GBp": 100}, minor_units_by_ticker={"RR": 100}).collect()}
    assert out == {"RR": D("6.0000"), "XOM": D("600.0000")}


def test_single_hot_ticker_is_spread_over_tasks(spark):
    """All rows belong to one ticker; the (ticker, bucket) window still spreads them."""
    rows = [("HOT", dt.date(2015, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        # consume the lagged column so the window stays in the plan
        out = segmented_lag(df, ["k"], "d", ["v"], bucket_days=30)
        parts = len(out.select(F.spark_partition_id().alias("p"), "prev_v")
                    .groupBy("p").agg(F.count("prev_v")).collect())
        plain = df.select(F.lag("v").over(Window.partitionBy("k").orderBy("d")).alias("x"))
        plain_parts = len(plain.select(F.spark_partition_id().alias("p"), "x")
                          .groupBy("p").agg(F.count("x")).collect())
    finally:
        spark.conf.set(key, old)
    assert plain_parts == 1 and parts > 1


def test_packed_order_equals_the_struct_order(spark):
    import random
    from quantleaf.operators.windows import latest_by_key, pack_order
    rnd = random.Random(2)
    pick = lambda n: None if rnd.random() < 0.1 else rnd.randint(0, n)
    rows = [(rnd.choice("abc"), pick(3), pick(2), i, pick(9)) for i in range(400)]
    rows = [r for k, r in {(r[0], r[1], r[2], r[4]): r for r in rows}.items()]      # the order is unique within a key
    df = spark.createDataFrame(rows, "k string, o1 int, o2 long, v int, o3 int").repartition(5)
    want = latest_by_key(df, ["k"], ["o1", "o2", "o3"], ["v"])
    got = latest_by_key(df, ["k"], ["o1", "o2", "o3"], ["v"], [2, 2, 2])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "SortAggregate" in want._jdf.queryExecution().executedPlan().toString()
    import pytest
    with pytest.raises(Exception, match="does not fit 1 digits"):
        df.select(pack_order(df, ["o3"], [1])).collect()
    with pytest.raises(ValueError):
        pack_order(df, ["o1", "o2"], [20, 20])


def test_dedupe_of_the_silver_tables_does_not_sort(spark):
    from quantleaf.config import EngineConfig
    from quantleaf.plans import refresh as P
    from quantleaf.sources import proxy
    b = proxy.load(spark, "/root/testdata/sf0.001")
    for name in ("silver_stock_prices", "silver_forex_rates", "silver_stock_fundamentals"):
        plan = P.build_silver_table(name, b, EngineConfig())._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan, name
