"""Gold operators (M6–M12) on literal silver frames: the reference's golden facts and
the decisions taken where its two implementations disagree."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal as D

import pytest

from quantleaf.config import EngineConfig
from quantleaf.operators import gold as G
from quantleaf.sources import seeds

AS_OF = dt.date(2025, 6, 30)
PRICE_SCHEMA = ("ticker string, trade_date date, open_price decimal(18,4), high_price decimal(18,4), "
                "low_price decimal(18,4), close_price decimal(18,4), volume bigint, "
                "daily_return_pct decimal(18,4), is_valid boolean")
FX_SCHEMA = "currency_pair string, trade_date date, close_rate decimal(18,6), daily_change_pct decimal(18,6), is_valid boolean"
COMP = "ticker string, company_name string, country string, exchange string, currency string, category string, region string"
FUND = ("ticker string, report_date date, market_cap bigint, pe_ratio decimal(18,4), pb_ratio decimal(18,4), "
        "dividend_yield decimal(18,6), dividend_per_share decimal(18,4), revenue bigint, net_profit bigint, "
        "roe decimal(18,4), debt_to_equity decimal(18,4), book_value decimal(18,4), shares_outstanding bigint, "
        "is_valid boolean")


def px(t, d, c, ret=None, hi=None, lo=None):
    c = D(str(c))
    return (t, d, c, D(str(hi)) if hi else c, D(str(lo)) if lo else c, c, 100,
            D(str(ret)) if ret is not None else None, True)


@pytest.fixture
def world(spark):
    prices = spark.createDataFrame([
        # A (USD): one year back exactly on the cut date, an older row, in-window rows
        px("A", dt.date(2024, 6, 1), 50), px("A", dt.date(2024, 6, 30), 100),
        px("A", dt.date(2024, 7, 1), 110, ret=10, hi=200), px("A", dt.date(2025, 6, 30), 120, ret=5, lo=90),
        # B (INR): short history → earliest-price fallback
        px("B", dt.date(2025, 3, 1), 40), px("B", dt.date(2025, 6, 30), 50, ret=25),
        # C (USD): constant prices → zero volatility
        px("C", dt.date(2024, 1, 1), 10), px("C", dt.date(2025, 6, 1), 10, ret=0), px("C", dt.date(2025, 6, 30), 10, ret=0),
        # E: a row exactly 365 days back is outside the 52-week window
        px("E", AS_OF - dt.timedelta(days=365), 70, hi=999, lo=1), px("E", AS_OF, 80, ret=14.2857),
    ], PRICE_SCHEMA)
    fx = spark.createDataFrame([
        ("USD/INR", dt.date(2024, 6, 28), D("83"), None, True),
        ("USD/INR", dt.date(2025, 6, 27), D("86"), None, True),
    ], FX_SCHEMA)
    companies = spark.createDataFrame([
        ("A", "A co", "USA", "NYSE", "USD", "Tech", "North America"),
        ("B", "B co", "India", "NSE", "INR", "Tech", "Asia"),
        ("C", "C co", "USA", "NYSE", "USD", "Oil", "North America"),
        ("E", "E co", "USA", "NYSE", "USD", "Oil", "North America"),
        ("Z", "No prices", "USA", "NYSE", "USD", "Oil", "North America"),
    ], COMP)
    fund = spark.createDataFrame([
        ("A", None, 1000, D("10"), None, D("0.020000"), D("2"), None, 500, None, None, None, 100, True),
        ("B", None, 2000, D("20"), None, None, None, None, None, None, None, None, 0, True),
        ("C", None, 3000, D("30"), None, D("0"), D("1"), None, None, None, None, None, 10, True),
    ], FUND)
    cfg = EngineConfig(as_of=AS_OF)
    return dict(prices=prices, fx=fx, companies=companies, fund=fund, cmap=seeds.currency_map(spark), cfg=cfg,
                stats=G.ticker_stats(prices, AS_OF, cfg), fxs=G.fx_stats(fx, AS_OF, cfg))


def by_ticker(df):
    return {r.ticker: r for r in df.collect()}


def test_stock_performance(world):
    w = world
    perf = by_ticker(G.stock_performance(w["stats"], w["companies"], w["fund"], w["cfg"]))
    # one-year edge: the row exactly on add_months(as_of, -12) is the year-ago price
    assert perf["A"].current_price == D("120.0000")
    assert perf["A"].yoy_return_pct == D("20.0000")
    # 52-week window excludes the row exactly 365 days back
    assert perf["E"].week_52_high == D("80.0000") and perf["E"].week_52_low == D("80.0000")
    assert perf["A"].week_52_high == D("200.0000") and perf["A"].week_52_low == D("90.0000")
    # short history falls back to the earliest price
    assert perf["B"].yoy_return_pct == D("25.0000")
    # a single in-window return → sample stdev NULL → Sharpe NULL; zero volatility → Sharpe NULL
    assert perf["B"].volatility is None and perf["B"].sharpe_ratio is None
    assert perf["C"].volatility == D("0.0000") and perf["C"].sharpe_ratio is None
    # Sharpe = return / rounded volatility
    assert perf["A"].volatility == D("3.5355")
    assert perf["A"].sharpe_ratio == D(str(round(20 / 3.5355, 4)))
    # a company without prices or fundamentals is kept (left joins)
    assert perf["Z"].current_price is None and perf["Z"].market_cap is None


def test_currency_adjusted_returns(world):
    w = world
    cur = by_ticker(G.currency_adjusted_returns(w["stats"], w["fxs"], w["companies"], w["cmap"], w["cfg"]))
    a = cur["A"]
    assert (a.inr_start_rate, a.inr_end_rate) == (D("83.000000"), D("86.000000"))
    assert a.return_inr_pct == D("24.3373")            # +20 % local, 83 → 86
    assert a.currency_impact_pct == D("4.3373")
    b = cur["B"]                                        # home currency: rate 1, impact 0
    assert (b.inr_start_rate, b.inr_end_rate, b.currency_impact_pct) == (D("1.000000"), D("1.000000"), D("0.0000"))
    assert b.return_inr_pct == b.return_local_pct


def test_missing_year_ago_fx(world, spark):
    w = world
    late_fx = w["fx"].where("trade_date > '2025-01-01'")
    fxs = G.fx_stats(late_fx, AS_OF, w["cfg"])
    strict = by_ticker(G.currency_adjusted_returns(w["stats"], fxs, w["companies"], w["cmap"], w["cfg"]))
    assert strict["A"].inr_start_rate is None and strict["A"].return_inr_pct is None
    faithful = replace(w["cfg"], fx_start_default_one=True)
    one = by_ticker(G.currency_adjusted_returns(w["stats"], fxs, w["companies"], w["cmap"], faithful))
    assert one["A"].inr_start_rate == D("1.000000")


def test_dividend_analysis(world):
    w = world
    div = by_ticker(G.dividend_analysis(w["stats"], w["fund"], w["fxs"], w["companies"], w["cmap"]))
    a = div["A"]   # EPS = 500/100 = 5; payout = 2/5
    assert a.payout_ratio == D("0.4000") and a.pays_dividend
    assert a.dividend_in_inr == D("172.0000")          # 2 × latest USD/INR 86
    assert div["B"].payout_ratio is None                # no profit, zero shares
    assert div["B"].dividend_in_inr == D("0.0000") and not div["B"].pays_dividend
    assert not div["C"].pays_dividend                   # yield 0 is not a payer


def test_category_and_region(world):
    w = world
    perf = G.stock_performance(w["stats"], w["companies"], w["fund"], w["cfg"])
    cat = {r.category: r for r in G.category_performance(perf).collect()}
    assert cat["Tech"].best_stock == "B" and cat["Tech"].worst_stock == "A"
    # NULL return (Z) never wins best or worst
    assert cat["Oil"].best_stock == "E" and cat["Oil"].worst_stock == "C"
    assert cat["Tech"].average_yoy_return_pct == D("22.5000")
    cur = G.currency_adjusted_returns(w["stats"], w["fxs"], w["companies"], w["cmap"], w["cfg"])
    reg = {r.region: r for r in G.region_performance(perf, cur).collect()}
    assert reg["Asia"].stock_count == 1 and reg["Asia"].avg_currency_impact_pct == D("0.0000")
    assert reg["North America"].stock_count == 4


def test_daily_inr_returns_policies(world):
    w = world
    cfg = w["cfg"]
    out = {(r.ticker, r.trade_date): r for r in
           G.daily_inr_returns(w["prices"], w["fx"], w["companies"], w["cmap"], cfg).collect()}
    # no USD/INR quote on 2024-06-30 → rate 1 (reference behaviour)
    assert out[("A", dt.date(2024, 6, 30))].forex_rate == D("1.00")
    assert out[("B", dt.date(2025, 6, 30))].currency_pair is None
    dense = G.densify_fx(w["fx"], AS_OF, 30)
    asof = replace(cfg, fx_policy="asof")
    out2 = {(r.ticker, r.trade_date): r for r in
            G.daily_inr_returns(w["prices"], w["fx"], w["companies"], w["cmap"], asof, dense).collect()}
    assert out2[("A", dt.date(2024, 6, 30))].forex_rate == D("83.00")   # last quote 2024-06-28
    assert out2[("A", dt.date(2025, 6, 30))].forex_rate == D("86.00")
    early = out2[("A", dt.date(2024, 6, 1))]                            # before the first quote: no rate, no value
    assert early.forex_rate is None and early.close_price_inr is None and early.close_price is not None
    assert out2[("B", dt.date(2025, 6, 30))].forex_rate == D("1.00")    # home currency


def test_stored_procedure_variant(world):
    """Where the two reference implementations disagree, reference_variant='sp' gives the
    stored procedures' answer."""
    w = world
    sp = replace(w["cfg"], reference_variant="sp")
    stats = G.ticker_stats(w["prices"], AS_OF, sp)
    perf = by_ticker(G.stock_performance(stats, w["companies"], w["fund"], sp))
    # inner joins: E has no fundamentals, Z no prices
    assert set(perf) == {"A", "B", "C"}
    div = by_ticker(G.dividend_analysis(stats, w["fund"], w["fxs"], w["companies"], w["cmap"], sp,
                                        G.stock_performance(stats, w["companies"], w["fund"], sp)))
    assert div["C"].pays_dividend                       # yield 0 is "not NULL" (C17)
    assert div["B"].dividend_in_inr is None             # non-payer: NULL, not 0 (C18)
    assert div["A"].payout_ratio == D("0.4000")         # 500 div 100 = 5 (C16)
    daily = {(r.ticker, r.trade_date): r for r in
             G.daily_inr_returns(w["prices"], w["fx"], w["companies"], w["cmap"], sp).collect()}
    assert daily[("A", dt.date(2024, 6, 30))].currency_pair is None      # matched FX row's pair (C19)
    assert daily[("A", dt.date(2025, 6, 30))].currency_pair is None      # no quote that day
    dbt_daily = {(r.ticker, r.trade_date): r for r in
                 G.daily_inr_returns(w["prices"], w["fx"], w["companies"], w["cmap"], w["cfg"]).collect()}
    assert dbt_daily[("A", dt.date(2024, 6, 30))].currency_pair == "USD/INR"


def test_sp_integer_eps_truncates(spark, world):
    w = world
    sp = replace(w["cfg"], reference_variant="sp")
    fund = spark.createDataFrame(
        [("A", None, 1, None, None, D("0.01"), D("1"), None, 250, None, None, None, 100, True)], FUND)
    div = by_ticker(G.dividend_analysis(w["stats"], fund, w["fxs"], w["companies"], w["cmap"], sp))
    assert div["A"].payout_ratio == D("0.5000")         # EPS 250 div 100 = 2 (truncated), not 2.5
    dbt = by_ticker(G.dividend_analysis(w["stats"], fund, w["fxs"], w["companies"], w["cmap"], w["cfg"]))
    assert dbt["A"].payout_ratio == D("0.4000")


def test_fx_options(world):
    w = world
    # 'null': a price date without a quote has no home-currency value
    null = replace(w["cfg"], fx_policy="null")
    out = {(r.ticker, r.trade_date): r for r in
           G.daily_inr_returns(w["prices"], w["fx"], w["companies"], w["cmap"], null).collect()}
    assert out[("A", dt.date(2024, 6, 30))].forex_rate is None
    assert out[("A", dt.date(2024, 6, 30))].close_price_inr is None
    # staleness cap: a quote older than 3 days is not carried forward
    dense = {(r.currency_pair, r.trade_date): r.close_rate for r in
             G.densify_fx(w["fx"], AS_OF, 30, max_stale_days=3).collect()}
    assert dense[("USD/INR", dt.date(2024, 7, 1))] == D("83.000000")
    assert dense[("USD/INR", dt.date(2024, 7, 2))] is None
    # align_fx: a short-history ticker takes the start rate on its own first date
    fx = w["fx"].union(w["fx"].sparkSession.createDataFrame(
        [("USD/INR", dt.date(2025, 2, 28), D("85"), None, True)], FX_SCHEMA))
    comp = w["companies"].where("ticker <> 'B'").union(w["companies"].sparkSession.createDataFrame(
        [("B", "B co", "USA", "NYSE", "USD", "Tech", "North America")], COMP))
    aligned = replace(w["cfg"], align_fx=True)
    cur = by_ticker(G.currency_adjusted_returns(w["stats"], G.fx_stats(fx, AS_OF, aligned), comp, w["cmap"],
                                                aligned, G.densify_fx(fx, AS_OF, 30)))
    assert cur["B"].inr_start_rate == D("85.000000")     # as of 2025-03-01, B's earliest price
    assert cur["A"].inr_start_rate == D("83.000000")     # as of A's year-ago date


def test_period_grains(world):
    from quantleaf.operators import measures as M
    w = world
    daily = G.daily_inr_returns(w["prices"], w["fx"], w["companies"], w["cmap"], w["cfg"])
    q = {(r.period, r.ticker): r for r in M.period_returns(daily, "quarter").collect()}
    assert q[(20243, "A")].first_close == D("110.00")
    assert q[(20252, "A")].local_return_pct is not None
    y = {(r.period, r.ticker): r for r in M.period_returns(daily, "year").collect()}
    assert y[(2024, "A")].local_return_pct == D("120.0000")   # 50 → 110


def test_sp_payout_exact_tie_rounds_half_up(spark, world):
    """9.979 / 4 = 2.49475 exactly: the decimal quotient rounds half up (a double would not)."""
    w = world
    sp = replace(w["cfg"], reference_variant="sp")
    fund = spark.createDataFrame(
        [("A", None, 1, None, None, D("0.01"), D("9.979"), None, 400, None, None, None, 100, True)], FUND)
    div = by_ticker(G.dividend_analysis(w["stats"], fund, w["fxs"], w["companies"], w["cmap"], sp))
    assert div["A"].payout_ratio == D("2.4948")


def test_scenario_and_week52_measures(spark):
    from quantleaf.operators import measures as M
    rets = spark.createDataFrame([("A", D("10.0000")), ("B", D("-5.0000"))],
                                 "ticker string, return_inr_pct decimal(18,4)")
    g = {(r.ticker, r.amount, r.tax_rate): r for r in
         M.scenario_returns(rets, amounts=(1000,), tax_rates=("0.2",)).collect()}
    a = g[("A", D("1000.00"), D("0.2000"))]
    assert (a.gross_gain, a.tax, a.net_gain, a.final_value) == (D("100.00"), D("20.00"), D("80.00"), D("1080.00"))
    b = g[("B", D("1000.00"), D("0.2000"))]       # no tax on a loss
    assert (b.gross_gain, b.tax, b.net_gain, b.final_value) == (D("-50.00"), D("0.00"), D("-50.00"), D("950.00"))
    perf = spark.createDataFrame([("A", D("15"), D("10"), D("20")), ("B", D("5"), D("5"), D("5"))],
                                 "ticker string, current_price decimal(18,4), week_52_low decimal(18,4), "
                                 "week_52_high decimal(18,4)")
    pos = {r.ticker: r.position_pct for r in M.week52_position(perf).collect()}
    assert pos == {"A": D("50.0000"), "B": None}   # a zero range has no position


def test_category_period_measures(spark):
    from quantleaf.operators import measures as M
    day = lambda m, d: dt.date(2025, m, d)
    rows = [("A", day(1, 2), D("10.00"), D("10.00"), D("1.00")), ("A", day(6, 2), D("12.00"), D("12.00"), D("3.00")),
            ("B", day(1, 2), D("20.00"), D("20.00"), D("2.00")), ("B", day(6, 2), D("24.00"), D("24.00"), D("2.00")),
            ("C", day(1, 2), D("5.00"), D("5.00"), None), ("C", day(6, 2), D("4.00"), D("4.00"), D("-20.00"))]
    daily = spark.createDataFrame(rows, "ticker string, trade_date date, close_price decimal(10,2), "
                                        "close_price_inr decimal(10,2), daily_return_local_pct decimal(10,2)")
    comp = spark.createDataFrame([("A", "X"), ("B", "X"), ("C", "Y")], "ticker string, category string")
    cat = {r.category: r for r in M.category_period_returns(daily, comp).collect()}
    assert cat["X"].avg_local_return_pct == D("20.0000") and cat["X"].ticker_count == 2   # A +20 %, B +20 %
    vol = {r.category: r.avg_volatility for r in M.category_period_volatility(daily, comp).collect()}
    assert vol["X"] == D("0.5000")          # population stdev: A → 1.0, B → 0.0
    bw = sorted((r.kind, r.ticker) for r in M.best_worst_stock(daily, comp).where("category = 'X'").collect())
    assert bw == [("best", "A"), ("best", "B"), ("worst", "A"), ("worst", "B")]   # ties kept
    fund = spark.createDataFrame([("A", D("0.6000"))], "ticker string, dividend_per_share decimal(18,4)")
    y = M.dynamic_dividend_yield(daily, fund).first()
    assert (y.last_close, y.dividend_yield_pct) == (D("12.00"), D("5.000000"))
