"""Ingestion (M14, S5–S7, J12, ST1) and validation jobs."""

import datetime as dt
import json
import os
from decimal import Decimal as D

from pyspark.sql import functions as F

from quantleaf import schemas
from quantleaf.operators import quality as Q
from quantleaf.sources import ingest as I
from quantleaf.sources import seeds
from quantleaf.streaming.incremental import bronze_rows, ingest_batch, run_price_ingest


def payload(symbol, exchange, currency, fetched, quotes):
    return {"symbol": symbol, "exchange": exchange, "currency": currency, "fetched_at": fetched,
            "values": [{"datetime": d, "open": str(c), "high": str(c), "low": str(c), "close": str(c),
                        "volume": "100"} for d, c in quotes]}


def land(path, docs):
    os.makedirs(path, exist_ok=True)
    n = len(os.listdir(path))
    with open(os.path.join(path, f"part-{n:04d}.json"), "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")


def test_symbol_mapping(spark):
    df = spark.createDataFrame([("VOW", "XETRA"), ("RR", "LSE"), ("CEG", "NASDAQ"), ("ONGC", "NSE")], "t string, e string")
    out = df.select(I.vendor_symbol(F.col("t"), F.col("e")).alias("s")).select("s", I.ticker_of(F.col("s")).alias("t"))
    got = {r.s: r.t for r in out.collect()}
    assert got == {"VOW3.DE": "VOW", "RR.L": "RR", "CEG": "CEG", "ONGC.NS": "ONGC"}


def test_parse_payload_files(spark, tmp_dir):
    land(tmp_dir, [payload("VOW3", "XETR", "EUR", "2025-01-03 02:30:00",
                           [("2025-01-02", "90.1234"), ("2025-01-03", "91.5")])])
    rows = I.parse_price_payloads(I.read_price_payloads(spark, tmp_dir)).collect()
    assert {(r.ticker, r.trade_date, r.close_price) for r in rows} == {
        ("VOW", dt.date(2025, 1, 2), D("90.1234")), ("VOW", dt.date(2025, 1, 3), D("91.5000"))}
    assert rows[0].api_fetched_at == dt.datetime(2025, 1, 3, 2, 30)


def test_newer_and_anti(spark):
    s = "ticker string, trade_date date"
    stored = spark.createDataFrame([("A", dt.date(2025, 1, 2)), ("A", dt.date(2025, 1, 5))], s)
    arriving = spark.createDataFrame([("A", dt.date(2025, 1, 3)), ("A", dt.date(2025, 1, 6)),
                                      ("B", dt.date(2025, 1, 1))], s)
    newer = {tuple(r) for r in I.newer_than_stored(stored, arriving).collect()}
    assert newer == {("A", dt.date(2025, 1, 6)), ("B", dt.date(2025, 1, 1))}
    anti = {tuple(r) for r in I.not_yet_stored(stored, arriving).collect()}
    assert anti == {("A", dt.date(2025, 1, 3)), ("A", dt.date(2025, 1, 6)), ("B", dt.date(2025, 1, 1))}


def test_streaming_ingest_is_idempotent(spark, tmp_dir):
    landing, bronze, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "bronze", "ckpt"))
    land(landing, [payload("RR", "LSE", "GBp", "2025-01-02 00:00:00", [("2025-01-02", "600")])])
    run_price_ingest(spark, landing, bronze, ckpt)
    # the same quote re-delivered in a new file, plus a new day
    land(landing, [payload("RR", "LSE", "GBp", "2025-01-03 00:00:00",
                           [("2025-01-02", "600"), ("2025-01-03", "610")])])
    run_price_ingest(spark, landing, bronze, ckpt)
    run_price_ingest(spark, landing, bronze, ckpt)   # nothing new: no-op
    rows = bronze_rows(spark, bronze).collect()
    assert sorted((r.ticker, r.trade_date) for r in rows) == [("RR", dt.date(2025, 1, 2)), ("RR", dt.date(2025, 1, 3))]


def test_retried_batch_is_not_doubled(spark, tmp_dir):
    """A micro-batch re-run with the same epoch id replaces its own output."""
    bronze = os.path.join(tmp_dir, "bronze")
    t = dt.datetime(2025, 1, 1)
    b0 = spark.createDataFrame([("A", dt.date(2025, 1, 2), D(1), D(1), D(1), D(1), 1, "X", "USD", t)],
                               schemas.BRONZE_PRICES)
    b1 = spark.createDataFrame([("A", dt.date(2025, 1, 2), D(2), D(2), D(2), D(2), 1, "X", "USD", t),
                                ("A", dt.date(2025, 1, 3), D(3), D(3), D(3), D(3), 1, "X", "USD", t)],
                               schemas.BRONZE_PRICES)
    ingest_batch(spark, b0, 0, bronze)
    ingest_batch(spark, b1, 1, bronze)
    ingest_batch(spark, b1, 1, bronze)          # retry of epoch 1
    got = sorted((r.trade_date, r.close_price) for r in bronze_rows(spark, bronze).collect())
    assert got == [(dt.date(2025, 1, 2), D("1.0000")), (dt.date(2025, 1, 3), D("3.0000"))]


def test_seed_csv_empty_is_null(spark, tmp_dir):
    path = os.path.join(tmp_dir, "currency_map.csv")
    with open(path, "w") as f:
        f.write("currency_code,currency_name,currency_country,forex_pair\n")
        for r in seeds.CURRENCY_ROWS:
            f.write(",".join("" if v is None else v for v in r) + "\n")
    got = {r.currency_code: r.forex_pair for r in seeds.currency_map_csv(spark, path).collect()}
    assert got["INR"] is None and got["USD"] == "USD/INR" and len(got) == 5
    assert seeds.companies(spark).count() == 12


def test_quality_jobs(spark):
    df = spark.createDataFrame([("A", dt.date(2025, 1, 2)), ("A", dt.date(2025, 1, 2)), (None, dt.date(2025, 1, 3))],
                               "ticker string, trade_date date")
    kv = Q.key_violations(df, ["ticker", "trade_date"], "t").first()
    assert (kv.duplicate_keys, kv.duplicate_rows, kv.null_keys) == (1, 2, 1)
    assert Q.previous_trading_day(dt.date(2025, 6, 30)) == dt.date(2025, 6, 27)   # Monday → Friday
    fr = Q.freshness(df.where("ticker IS NOT NULL"), "ticker", dt.date(2025, 1, 6)).first()
    assert fr.expected_date == dt.date(2025, 1, 3) and not fr.is_fresh and fr.days_behind == 1
    rc = {r.table_name: r.row_count for r in Q.row_counts({"x": df, "y": df.limit(1)}).collect()}
    assert rc == {"x": 3, "y": 1}


def test_refresh_all_writes_every_table(spark, tmp_dir):
    from quantleaf.plans import refresh as P
    from quantleaf.sources import proxy
    paths = P.refresh_all(spark, proxy.load(spark, "/root/testdata/sf0.001"), tmp_dir)
    assert set(paths) == {"gold_stock_performance", "gold_currency_adjusted_returns", "gold_category_performance",
                          "gold_region_performance", "gold_dividend_analysis", "gold_correlation_matrix",
                          "gold_daily_inr_returns"}
    counts = {n: spark.read.parquet(p).count() for n, p in paths.items()}
    assert counts["gold_stock_performance"] == 25 and counts["gold_category_performance"] == 4
    assert counts["gold_region_performance"] == 5 and counts["gold_correlation_matrix"] > 0
    from quantleaf.plans import versions
    version = versions.current(spark, tmp_dir)
    silver = version.table("silver_stock_prices")
    assert silver.count() == counts["gold_daily_inr_returns"]
    cal = version.table("silver_calendar")
    span = silver.agg(F.min("trade_date").alias("a"), F.max("trade_date").alias("b")).first()
    assert cal.count() == (span.b - span.a).days + 1


def test_real_bronze_reader_runs_refresh(spark, tmp_dir):
    """Bronze tables with the declared schemas and the seed dimensions feed the same refresh."""
    from quantleaf.plans import refresh as P
    from quantleaf.sources import bronze as B
    from quantleaf.config import EngineConfig
    t = dt.datetime(2025, 1, 1)
    prices = [("RR", dt.date(2025, 1, 2), D(600), D(600), D(600), D(600), 1, "LSE", "GBp", t),
              ("RR", dt.date(2025, 1, 3), D(660), D(660), D(660), D(660), 1, "LSE", "GBp", t),
              ("CEG", dt.date(2025, 1, 3), D(200), D(200), D(200), D(200), 1, "NASDAQ", "USD", t)]
    spark.createDataFrame(prices, schemas.BRONZE_PRICES).write.parquet(os.path.join(tmp_dir, "bronze_stock_prices"))
    spark.createDataFrame([], schemas.BRONZE_FUNDAMENTALS).write.parquet(os.path.join(tmp_dir, "bronze_stock_fundamentals"))
    spark.createDataFrame([("GBP/INR", dt.date(2025, 1, 3), None, None, None, D(110), t)], schemas.BRONZE_FOREX) \
        .write.parquet(os.path.join(tmp_dir, "bronze_forex_rates"))
    b = B.load(spark, tmp_dir)
    silver = P.build_silver(b, EngineConfig())
    g = P.build_gold(silver, EngineConfig())
    perf = {r.ticker: r for r in g["gold_stock_performance"].collect()}
    assert len(perf) == 12 and perf["RR"].current_price == D("6.6000") and perf["RR"].yoy_return_pct == D("10.0000")
    daily = {(r.ticker, r.trade_date): r for r in g["gold_daily_inr_returns"].collect()}
    assert daily[("RR", dt.date(2025, 1, 3))].close_price_inr == D("726.00")


def test_slicers(spark):
    from quantleaf.operators import measures as M
    df = spark.createDataFrame([("A", dt.date(2024, 5, 1)), ("A", dt.date(2025, 5, 1)), ("B", dt.date(2025, 5, 1))],
                               "ticker string, trade_date date")
    assert M.slice_daily(df, tickers=["A"], years=[2025]).count() == 1
    assert M.slice_daily(df, start=dt.date(2025, 1, 1)).count() == 2


def test_streaming_newer_mode_uses_watermarks(spark, tmp_dir):
    landing, bronze, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "bronze", "ckpt"))
    land(landing, [payload("RR", "LSE", "GBp", "2025-01-03 00:00:00", [("2025-01-03", "600")])])
    run_price_ingest(spark, landing, bronze, ckpt, mode="newer")
    # an older day arrives later: not newer than what is stored → dropped; a newer day is kept
    land(landing, [payload("RR", "LSE", "GBp", "2025-01-05 00:00:00",
                           [("2025-01-02", "590"), ("2025-01-04", "610")])])
    run_price_ingest(spark, landing, bronze, ckpt, mode="newer")
    got = sorted(r.trade_date for r in bronze_rows(spark, bronze).collect())
    assert got == [dt.date(2025, 1, 3), dt.date(2025, 1, 4)]
    marks = spark.read.parquet(bronze + "_latest").groupBy("ticker").agg(F.max("trade_date").alias("d")).first()
    assert marks.d == dt.date(2025, 1, 4)


def test_missing_fetch_time_defaults_to_given_ingest_time(spark, tmp_dir):
    import datetime as dt
    at = dt.datetime(2025, 1, 4, 3, 0)
    land(tmp_dir, [{"symbol": "CEG", "exchange": "NASDAQ", "currency": "USD",
                    "values": [{"datetime": "2025-01-02", "close": "10", "volume": "1"}]}])
    r = I.parse_price_payloads(I.read_price_payloads(spark, tmp_dir), at).first()
    assert r.api_fetched_at == at and r.close_price == D("10.0000") and r.open_price is None


def test_refresh_all_sp_variant(spark, tmp_dir):
    from quantleaf.config import EngineConfig
    from quantleaf.plans import refresh as P
    from quantleaf.sources import proxy
    paths = P.refresh_all(spark, proxy.load(spark, "/root/testdata/sf0.001"), tmp_dir,
                          EngineConfig(reference_variant="sp"))
    perf = spark.read.parquet(paths["gold_stock_performance"])
    cur = spark.read.parquet(paths["gold_currency_adjusted_returns"])
    div = spark.read.parquet(paths["gold_dividend_analysis"])
    n = perf.count()
    assert 0 < n <= 25 and cur.count() == n and div.count() == n
    assert perf.where("ticker IS NULL").count() == 0


def test_forex_and_fundamental_payload_files(spark, tmp_dir):
    fx_dir, fund_dir = os.path.join(tmp_dir, "fx"), os.path.join(tmp_dir, "fund")
    land(fx_dir, [{"symbol": "USD/INR", "fetched_at": "2025-01-03 00:00:00",
                   "values": [{"datetime": "2025-01-02", "close": "85.123456"}]}])
    land(fund_dir, [{"symbol": "VOW3.DE", "fetched_at": "2025-01-03 00:00:00", "market_cap": "1000",
                     "pe_ratio": "4.5", "shares_outstanding": "10"}])
    fx = I.parse_forex_payloads(spark.read.schema(schemas.FOREX_PAYLOAD).json(fx_dir)).first()
    assert (fx.currency_pair, fx.trade_date, fx.close_rate, fx.open_rate) == \
        ("USD/INR", dt.date(2025, 1, 2), D("85.123456"), None)
    fu = I.parse_fundamental_payloads(spark.read.schema(schemas.FUNDAMENTALS_PAYLOAD).json(fund_dir)).first()
    assert (fu.ticker, fu.market_cap, fu.pe_ratio, fu.revenue) == ("VOW", 1000, D("4.5000"), None)


def test_refresh_into_catalog_tables(spark):
    """The refresh writes catalog tables (CTAS-style saveAsTable) when given database names."""
    from quantleaf.plans import refresh as P
    from quantleaf.sources import proxy
    spark.sql("CREATE DATABASE IF NOT EXISTS ql_silver")
    spark.sql("CREATE DATABASE IF NOT EXISTS ql_gold")
    paths = P.refresh_all(spark, proxy.load(spark, "/root/testdata/sf0.001"), "ql_silver", gold_dir="ql_gold")
    assert paths["gold_stock_performance"].startswith("ql_gold.gold_stock_performance__")
    from quantleaf.plans import versions
    assert versions.current(spark, "ql_gold").table("gold_stock_performance").count() == 25
    assert versions.current(spark, "ql_silver").table("silver_calendar").count() > 0


def test_pair_count_and_layer_listing(spark):
    prices = spark.createDataFrame([("A", D(1)), ("B", D(2)), ("C", None), ("C", D(3))],
                                   "ticker string, daily_return_pct decimal(18,4)")
    corr = spark.createDataFrame([("A", "B"), ("A", "C")], "stock_1 string, stock_2 string")
    r = Q.pair_count_check(corr, prices).first()
    assert (r.n, r.pairs, r.expected_pairs, r.complete) == (3, 2, 3, False)
    t = spark.createDataFrame([(1, "x")], "id int, name string")
    lst = Q.layer_listing({"t": t}, {"t": "silver"}).first()
    assert (lst.layer, lst.table_name, lst.row_count, lst.column_count, lst.columns) == ("silver", "t", 1, 2, "id, name")


def _price_doc(ticker, date, close, fetched="2024-01-01 00:00:00"):
    import json
    return json.dumps({"symbol": ticker, "exchange": "XETR", "currency": "EUR", "fetched_at": fetched, "values": [
        {"datetime": date, "open": "1", "high": "1", "low": "1", "close": close, "volume": "1"}]})


def test_new_checkpoint_and_second_feed_keep_stored_rows(spark, tmp_dir):
    """Batch numbers start again with a new checkpoint; the stored rows must stay."""
    import os
    for k in ("a", "b"):
        os.makedirs(f"{tmp_dir}/{k}")
    bronze = f"{tmp_dir}/bronze"
    with open(f"{tmp_dir}/a/1.json", "w") as f:
        f.write(_price_doc("VOW3", "2024-01-02", "10"))
    run_price_ingest(spark, f"{tmp_dir}/a", bronze, f"{tmp_dir}/c1")
    with open(f"{tmp_dir}/b/1.json", "w") as f:
        f.write(_price_doc("VOW3", "2024-01-02", "99") + "\n" + _price_doc("BP.A", "2024-01-03", "11"))
    run_price_ingest(spark, f"{tmp_dir}/b", bronze, f"{tmp_dir}/c2")       # another feed, batch 0 again
    run_price_ingest(spark, f"{tmp_dir}/a", bronze, f"{tmp_dir}/c3")       # the first feed from a reset checkpoint
    got = sorted((r.ticker, str(r.trade_date), float(r.close_price), r.exchange) for r in bronze_rows(spark, bronze).collect())
    assert got == [("BP.A", "2024-01-03", 11.0, "XETRA"), ("VOW", "2024-01-02", 10.0, "XETRA")]


def test_price_symbols_are_bare_and_fetch_time_is_given(spark):
    import datetime as dt

    from quantleaf.sources import ingest as I
    docs = spark.createDataFrame([(_price_doc("VOW3", "2024-01-02", "10", None),), (_price_doc("ABC.DE", "2024-01-02", "10"),)], "value string")
    at = dt.datetime(2024, 5, 1, 12, 0)
    rows = {r.ticker: r for r in I.parse_price_payloads(I.payloads_from_strings(docs), at).collect()}
    assert set(rows) == {"VOW", "ABC.DE"} and rows["VOW"].api_fetched_at == at
    assert {r.api_fetched_at for r in I.parse_price_payloads(I.payloads_from_strings(docs)).collect()} == {None, dt.datetime(2024, 1, 1)}
    sym = spark.createDataFrame([("VOW", "XETRA"), ("BP", "LSE")], "t string, e string").select(
        I.price_symbol(F.col("t")).alias("p"), I.price_exchange(F.col("e")).alias("x"), I.vendor_symbol(F.col("t"), F.col("e")).alias("f"))
    assert [tuple(r) for r in sym.collect()] == [("VOW3", "XETR", "VOW3.DE"), ("BP", "LSE", "BP.L")]


def test_stored_keys_are_counted_before_the_duplicate_check(spark, tmp_dir, monkeypatch):
    """Bronze is larger than a broadcast may be, its keys are few: the batch is joined without a shuffle."""
    from quantleaf.streaming import incremental as N
    bronze, t = f"{tmp_dir}/bronze", dt.datetime(2025, 1, 1)

    def prices(days, n):
        rows = [("A", dt.date(2025, 1, 1 + k % days), D(k), D(k * 7 % 1009), D(k * 11 % 997), D(k * 13 % 991), k * 7919, "X", "USD", t) for k in range(n)]
        return spark.createDataFrame(rows, schemas.BRONZE_PRICES)

    plans, write = [], N._write_epoch

    def spied(df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, path)

    ingest_batch(spark, prices(5, 20_000), "a", bronze)
    monkeypatch.setattr(N, "_write_epoch", spied)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        ingest_batch(spark, prices(7, 700), "b", bronze)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0], plans[0]
    got = {str(r.trade_date): r["count"] for r in bronze_rows(spark, bronze).groupBy("trade_date").count().collect()}
    assert got == {f"2025-01-0{d}": 4000 if d < 6 else 100 for d in range(1, 8)}


def test_streams_land_compressed_documents_and_hold_no_accepted_text(spark, tmp_dir):
    import glob

    from quantleaf.plans import catalog
    sf, n = f"{tmp_dir}/sf", 600
    spark.createDataFrame([(k, f"Brand#{11 + k}") for k in range(5)], "p_partkey long, p_brand string").write.parquet(f"{sf}/part.parquet")
    lines = [(k // 2, k % 5, k, k % 2, 10.0, 1000.0 + k, 0.1, 0.05, dt.date(1995, 1, 1 + k % 28)) for k in range(n)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                 "l_discount double, l_tax double, l_shipdate date").write.parquet(f"{sf}/lineitem.parquet")
    for query in ("stream_ingest", "stream_rejects"):
        folders = f"{spark.conf.get('spark.checkpoint.dir')}/{query.replace('_', '-')}-*"
        known = set(glob.glob(folders))
        assert catalog.queries()[query](spark, sf).count()
        run, = set(glob.glob(folders)) - known
        for landing in glob.glob(f"{run}/landing*"):
            stored = sum(os.path.getsize(f) for f in glob.glob(f"{landing}/part-*"))
            text = spark.read.text(landing).agg(F.sum(F.length("value"))).first()[0]
            assert stored < text / 2, (query, stored, text)
    checked = I.check_payloads(spark.createDataFrame([(_price_doc("VOW3", "2024-01-02", "10"), "f"), ("{", "f")], "value string, file string"), I.PRICE_FEED)
    held = {r.ticker: r for r in I.without_accepted_text(checked).collect()}
    assert held["VOW"].text is None and held["VOW"].file is None and (held[None].text, held[None].file) == ("{", "f")
    assert I.accepted(I.without_accepted_text(checked), I.PRICE_FEED).collect() == I.accepted(checked, I.PRICE_FEED).collect()
