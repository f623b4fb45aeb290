"""Gold layer (M6–M12) over silver DataFrames.

Every "latest", "earliest" and "as of a cut date" lookup is an aggregate in one
``groupBy(key)`` with a partial (map-side) step (R1, R2): a single scan of the
silver prices feeds M6, M7 and M10, and a hot ticker adds at most one partial
row per map task to the shuffle. The dimension-sized results (one row per
ticker / pair / category) are then joined; their join strategy is left to the
planner and AQE, which broadcast them only while their measured size is small.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantleaf.config import EngineConfig
from quantleaf.functions import exprs as X
from quantleaf.operators.asof import asof_join
from quantleaf.operators.windows import segmented_ffill, segmented_lag
from quantleaf.session import checkpointed


def resolve_as_of(prices: DataFrame, cfg: EngineConfig) -> dt.date:
    """The reporting date: the configured one, else the last trade date (one scalar)."""
    if cfg.as_of is not None:
        return cfg.as_of
    return prices.agg(F.max("trade_date")).first()[0]


def ticker_stats(prices: DataFrame, as_of: dt.date, cfg: EngineConfig) -> DataFrame:
    """Everything M6/M7/M10/M32 need per ticker, in one aggregate."""
    d = F.col("trade_date")
    cut = F.add_months(F.lit(as_of), -cfg.lookback_months)
    if cfg.sp:   # DATEADD(YEAR, -1, GETDATE()) with a time of day: the cut date itself is out
        win = (d > cut) & (d <= F.lit(as_of))
    else:
        win = X.in_trailing_window(d, as_of, cfg.window_days)
    before_cut = F.when(d <= cut, d)
    return (prices.where(d <= F.lit(as_of))
            .groupBy("ticker")
            .agg(F.max_by("close_price", d).alias("current_price"),
                 F.max(d).alias("current_date"),
                 F.max_by("volume", d).alias("latest_volume"),
                 F.min_by("close_price", d).alias("earliest_price"),
                 F.min(d).alias("earliest_date"),
                 F.max_by("close_price", before_cut).alias("year_ago_price"),
                 F.max(before_cut).alias("year_ago_date"),
                 F.max(F.when(win, F.col("high_price"))).alias("week_52_high"),
                 F.min(F.when(win, F.col("low_price"))).alias("week_52_low"),
                 F.stddev_samp(F.when(win, F.col("daily_return_pct"))).alias("_vol"),
                 F.count(F.when(win, F.lit(1))).alias("window_rows"))
            .withColumn("base_price", F.coalesce("year_ago_price", "earliest_price"))
            .withColumn("base_date", F.when(F.col("year_ago_price").isNotNull(), F.col("year_ago_date"))
                        .otherwise(F.col("earliest_date")))
            .withColumn("yoy_raw", X.exact_pct("current_price", "base_price", 4))
            .withColumn("volatility", X.to_dec("_vol"))
            .withColumnRenamed("_vol", "volatility_raw"))


def fx_stats(fx: DataFrame, as_of: dt.date, cfg: EngineConfig) -> DataFrame:
    """R2: latest rate and the rate as of the year-ago cut, per pair."""
    d = F.col("trade_date")
    cut = F.add_months(F.lit(as_of), -cfg.lookback_months)
    return (fx.where(d <= F.lit(as_of))
            .groupBy("currency_pair")
            .agg(F.max_by("close_rate", d).alias("end_rate"),
                 F.max_by("close_rate", F.when(d <= cut, d)).alias("start_rate")))


def ticker_pairs(companies: DataFrame, currency_map: DataFrame) -> DataFrame:
    """ticker → home-currency FX pair (NULL for home-currency tickers)."""
    cm = currency_map.select("currency_code", "forex_pair")
    return (companies.join(cm, companies.currency == cm.currency_code, "left")
            .select(companies["*"], cm.forex_pair))


def stock_performance(stats: DataFrame, companies: DataFrame, fundamentals: DataFrame,
                      cfg: EngineConfig) -> DataFrame:
    """M6 gold_stock_performance.

    dbt: left joins from the companies; Sharpe on the volatility rounded to 4 dp,
    NULL for zero/NULL volatility. sp: only tickers with prices in the window and
    fundamentals; Sharpe on the raw sample stdev (a zero stdev gives NULL here
    where the procedure would fail).
    """
    f = fundamentals.select("ticker", "pe_ratio", "market_cap", "roe", "debt_to_equity", "dividend_yield")
    if cfg.sp:
        j = (companies.join(stats.where(F.col("window_rows") > 0), "ticker", "inner")
             .join(f, "ticker", "inner"))
        # a raw deviation is a double: so is the quotient
        yoy = X.pct_change("current_price", "base_price")
        sharpe = (yoy - F.lit(float(cfg.risk_free))) / F.nullif(F.col("volatility_raw"), F.lit(0.0))
    else:
        j = companies.join(stats, "ticker", "left").join(f, "ticker", "left")
        # (return - risk-free) / volatility over the unrounded return: one quotient of integers
        cur, base, vol, rf = (X.unscaled(c, 4) for c in ("current_price", "base_price", "volatility", F.lit(Decimal(str(cfg.risk_free)))))
        sharpe = X.exact_quotient((cur - base) * F.lit(Decimal(10) ** 10) - rf * base * 10_000, base * vol, 18, 4)
    return j.select(
        "ticker", "company_name", "category", "region", "currency",
        X.to_dec("current_price").alias("current_price"),
        X.to_dec("yoy_raw").alias("yoy_return_pct"),
        X.to_dec("week_52_high").alias("week_52_high"),
        X.to_dec("week_52_low").alias("week_52_low"),
        "volatility",
        X.to_dec(sharpe).alias("sharpe_ratio"),
        "pe_ratio", "market_cap", "roe", "debt_to_equity", "dividend_yield")


def currency_adjusted_returns(stats: DataFrame, fxs: DataFrame, companies: DataFrame,
                              currency_map: DataFrame, cfg: EngineConfig,
                              fx_asof: DataFrame | None = None, universe: DataFrame | None = None) -> DataFrame:
    """M7 gold_currency_adjusted_returns.

    ``fx_asof`` (pair, trade_date, close_rate on every day) is needed only for
    ``cfg.align_fx``: the start rate is then taken on the price's own base date.
    sp: home currency is the currency code (not a missing pair), missing rates stay
    NULL, and only tickers in ``universe`` (the sp gold_stock_performance) are kept.
    """
    tp = ticker_pairs(companies, currency_map)
    if universe is not None:
        tp = tp.join(universe.select("ticker"), "ticker", "inner")
    j = (tp.join(stats.select("ticker", "yoy_raw", "base_date"), "ticker", "left")
         .join(fxs, tp.forex_pair == fxs.currency_pair, "left"))
    start = F.col("start_rate")
    if cfg.align_fx and fx_asof is not None:
        a = fx_asof.select(F.col("currency_pair").alias("_p"), F.col("trade_date").alias("_d"),
                           F.col("close_rate").alias("_aligned"))
        j = j.join(a, (j.forex_pair == a._p) & (j.base_date == a._d), "left")
        start = F.col("_aligned")
    home = (F.col("currency") == F.lit(cfg.home_currency)) if cfg.sp else F.col("forex_pair").isNull()
    one = F.lit(1).cast("decimal(18,6)")
    if cfg.sp:
        start_r = F.when(home, one).otherwise(start)
        end_r = F.when(home, one).otherwise(F.col("end_rate"))
    elif cfg.fx_start_default_one:
        start_r, end_r = F.coalesce(start, one), F.coalesce(F.col("end_rate"), one)
    else:
        start_r = F.when(home, one).otherwise(start)
        end_r = F.when(home, one).otherwise(F.col("end_rate"))
    local = X.to_dec("yoy_raw")
    return j.select(
        "ticker", "company_name", "category", "region",
        F.col("currency").alias("original_currency"),
        local.alias("return_local_pct"),
        X.to_dec(start_r, 18, 6).alias("inr_start_rate"),
        X.to_dec(end_r, 18, 6).alias("inr_end_rate"),
        F.when(home, local).otherwise(X.exact_compound(local, end_r, start_r)).alias("return_inr_pct"),
        F.when(home, F.lit(0).cast("decimal(18,4)"))
         .otherwise(X.exact_compound(local, end_r, start_r, less_local=True)).alias("currency_impact_pct"))


def _best(label: str, value: str, desc: bool = True):
    """Label of the row with the best value in the group; NULL values never win, ties → smallest label."""
    v = F.col(value)
    key = F.struct((-v if desc else v).alias("v"), F.col(label).alias("l"))
    return F.min_by(F.col(label), F.when(v.isNotNull(), key))


def _best_nulls(label: str, value: str, desc: bool, nulls_first: bool):
    """Like ``_best`` but NULL values take part, ranked first or last (T-SQL ROW_NUMBER order)."""
    v = F.col(value)
    flag = F.when(v.isNull(), F.lit(0 if nulls_first else 1)).otherwise(F.lit(1 if nulls_first else 0))
    key = F.struct(flag.alias("f"), (-v if desc else v).alias("v"), F.col(label).alias("l"))
    return F.min_by(F.col(label), key)


def category_performance(perf: DataFrame, cfg: EngineConfig | None = None) -> DataFrame:
    """M8 gold_category_performance. sp: a NULL return sorts first for the worst stock
    (ascending ROW_NUMBER in T-SQL) and last for the best."""
    if cfg is not None and cfg.sp:
        best = _best_nulls("ticker", "yoy_return_pct", desc=True, nulls_first=False)
        worst = _best_nulls("ticker", "yoy_return_pct", desc=False, nulls_first=True)
    else:
        best = _best("ticker", "yoy_return_pct", desc=True)
        worst = _best("ticker", "yoy_return_pct", desc=False)
    return (perf.groupBy("category")
            .agg(X.to_dec(F.avg("yoy_return_pct")).alias("average_yoy_return_pct"),
                 X.to_dec(F.avg("volatility")).alias("avg_volatility"),
                 best.alias("best_stock"),
                 worst.alias("worst_stock"),
                 X.to_dec(F.avg("pe_ratio")).alias("avg_pe_ratio"),
                 F.sum("market_cap").alias("total_market_cap"),
                 X.to_dec(F.avg("dividend_yield"), 18, 6).alias("avg_dividend_yield")))


def region_performance(perf: DataFrame, cur: DataFrame, cfg: EngineConfig | None = None) -> DataFrame:
    """M9 gold_region_performance.

    dbt: best category by average return, currency impact averaged separately (NULL → 0).
    sp: best category = category of the region's best stock; every figure over the
    tickers present in both gold tables (inner join).
    """
    if cfg is not None and cfg.sp:
        best = perf.groupBy("region").agg(
            _best_nulls("category", "yoy_return_pct", desc=True, nulls_first=False).alias("best_category"))
        j = perf.join(cur.select("ticker", "currency_impact_pct"), "ticker", "inner")
        stats = (j.groupBy("region")
                 .agg(X.to_dec(F.avg("yoy_return_pct")).alias("avg_yoy_return_pct"),
                      X.to_dec(F.avg("volatility")).alias("avg_volatility"),
                      X.to_dec(F.avg("sharpe_ratio")).alias("avg_sharpe_ratio"),
                      F.count("ticker").cast("int").alias("stock_count"),
                      X.to_dec(F.avg("currency_impact_pct")).alias("avg_currency_impact_pct")))
        return (stats.join(best, "region", "inner")
                .select("region", "avg_yoy_return_pct", "avg_volatility", "avg_sharpe_ratio", "stock_count",
                        "best_category", "avg_currency_impact_pct"))
    stats = (perf.groupBy("region")
             .agg(X.to_dec(F.avg("yoy_return_pct")).alias("avg_yoy_return_pct"),
                  X.to_dec(F.avg("volatility")).alias("avg_volatility"),
                  X.to_dec(F.avg("sharpe_ratio")).alias("avg_sharpe_ratio"),
                  F.count(F.lit(1)).cast("int").alias("stock_count")))
    best = (perf.groupBy("region", "category").agg(F.avg("yoy_return_pct").alias("category_avg"))
            .groupBy("region").agg(_best("category", "category_avg").alias("best_category")))
    impact = cur.groupBy("region").agg(X.to_dec(F.avg("currency_impact_pct")).alias("_ci"))
    return (stats.join(best, "region", "left").join(impact, "region", "left")
            .select("region", "avg_yoy_return_pct", "avg_volatility", "avg_sharpe_ratio", "stock_count",
                    "best_category",
                    F.coalesce(F.col("_ci"), F.lit(0).cast("decimal(18,4)")).alias("avg_currency_impact_pct")))


def dividend_analysis(stats: DataFrame, fundamentals: DataFrame, fxs: DataFrame,
                      companies: DataFrame, currency_map: DataFrame, cfg: EngineConfig | None = None,
                      universe: DataFrame | None = None) -> DataFrame:
    """M10 gold_dividend_analysis.

    dbt: payout = DPS / (profit / shares) in non-integer arithmetic with guards; home
    value 0 for non-payers; payer = yield > 0. sp: EPS is BIGINT/BIGINT (truncated),
    home value NULL for non-payers (DPS × rate, DPS itself for home-currency stocks),
    payer = yield not NULL, only tickers in ``universe`` with fundamentals.
    """
    sp = cfg is not None and cfg.sp
    tp = ticker_pairs(companies, currency_map)
    f = fundamentals.select("ticker", "dividend_per_share", "dividend_yield", "net_profit", "shares_outstanding")
    j = tp.join(stats.select("ticker", "current_price"), "ticker", "left")
    j = j.join(f, "ticker", "inner" if sp else "left")
    if universe is not None:
        j = j.join(universe.select("ticker"), "ticker", "inner")
    j = j.join(fxs.select("currency_pair", "end_rate"), tp.forex_pair == fxs.currency_pair, "left")
    np_, sh, dps = F.col("net_profit"), F.col("shares_outstanding"), F.col("dividend_per_share")
    dy = F.col("dividend_yield")
    if sp:
        # BIGINT/BIGINT EPS (truncated), then an exact decimal quotient as in the procedures
        eps = F.expr("net_profit div nullif(shares_outstanding, 0)").cast("decimal(20,0)")
        payout = dps / F.nullif(eps, F.lit(0).cast("decimal(20,0)"))
        home = F.col("currency") == F.lit(cfg.home_currency)
        inr = F.when(home, dps).otherwise(dps * F.col("end_rate"))
        pays = dy.isNotNull()
    else:
        eps = X.safe_div(np_, sh)
        payout = F.when(np_.isNotNull() & sh.isNotNull() & (sh > 0), X.safe_div(dps, eps))
        inr = (F.coalesce(dps, F.lit(0).cast("decimal(18,4)"))
               * F.coalesce(F.col("end_rate"), F.lit(1).cast("decimal(18,6)")))
        pays = dy.isNotNull() & (dy > 0)
    return j.select(
        "ticker", "company_name", "category", "region",
        X.to_dec("current_price").alias("stock_price"),
        X.to_dec(dps).alias("annual_dividend"),
        X.to_dec(dy, 18, 6).alias("dividend_yield_pct"),
        X.to_dec(payout).alias("payout_ratio"),
        X.to_dec(inr).alias("dividend_in_inr"),
        pays.alias("pays_dividend"))


def densify_fx(fx: DataFrame, until: dt.date | None = None, bucket_days: int = 90,
               max_stale_days: int | None = None) -> DataFrame:
    """One rate per pair per calendar day from the pair's first quote, forward filled.

    The day grid per pair is bounded by the calendar span, not by the data volume.
    """
    spans = fx.groupBy("currency_pair").agg(F.min("trade_date").alias("_s"), F.max("trade_date").alias("_e"))
    end = F.lit(until) if until is not None else F.col("_e")
    days = spans.select("currency_pair", F.explode(F.sequence("_s", F.greatest(end, F.col("_s")))).alias("trade_date"))
    quoted = fx.select("currency_pair", "trade_date", "close_rate",
                       F.col("trade_date").alias("quote_date"))
    dense = days.join(quoted, ["currency_pair", "trade_date"], "left")
    filled = segmented_ffill(dense, ["currency_pair"], "trade_date", ["close_rate", "quote_date"],
                             bucket_days, flag_col=None)
    if max_stale_days is not None:
        stale = F.datediff("trade_date", "quote_date") > max_stale_days
        filled = filled.withColumn("close_rate", F.when(stale, F.lit(None)).otherwise(F.col("close_rate")))
    return filled


def daily_inr_returns(prices: DataFrame, fx: DataFrame, companies: DataFrame, currency_map: DataFrame,
                      cfg: EngineConfig, fx_dense: DataFrame | None = None) -> DataFrame:
    """M12 gold_daily_inr_returns: close in home currency and its daily return.

    ``cfg.fx_policy``: 'exact_or_one' (a missing rate counts as 1, as the
    reference), 'asof' (last known rate at or before the day, an as-of join; or the day's row of ``fx_dense``),
    'null' (missing rate → NULL home-currency values). Under the last two, rows before a pair's first quote have no
    home-currency value, and only home-currency rows have rate 1. A value beyond DECIMAL(10,2) fails (ANSI casts).
    The priced rows are stored once: the lag reads them twice (rows and bucket tails).
    """
    cm = currency_map.select("currency_code", "forex_pair")
    tp = companies.select("ticker", "currency").join(cm, F.col("currency") == cm.currency_code, "inner")
    p = prices.select("ticker", "trade_date", "close_price", "daily_return_pct").join(
        tp.select("ticker", "forex_pair"), "ticker", "inner")
    src = fx_dense if (cfg.fx_policy == "asof" and fx_dense is not None) else fx
    r = src.select(F.col("currency_pair").alias("forex_pair"), "trade_date", F.col("close_rate").alias("_rate"))
    if cfg.fx_policy == "asof" and fx_dense is None:
        j = asof_join(p, r, ["forex_pair"], "trade_date", ["_rate"], cfg.bucket_days, salts=cfg.asof_salts)
    else:
        j = p.join(r, ["forex_pair", "trade_date"], "left")
    one = F.lit(1).cast("decimal(18,6)")
    if cfg.fx_policy == "exact_or_one":
        rate = F.coalesce(F.col("_rate"), one)
    else:       # only the home currency has rate 1; a pair without a (known) quote has none
        rate = F.when(F.col("forex_pair").isNull(), one).otherwise(F.col("_rate"))
    j = (j.withColumn("forex_rate", rate)
         .withColumn("close_inr", (F.col("close_price") * F.col("forex_rate")).cast("decimal(38,10)")))
    lagged = segmented_lag(checkpointed(j), ["ticker"], "trade_date", ["close_inr"], cfg.bucket_days)
    return lagged.select(
        "ticker", "trade_date",
        X.to_dec("close_price", 10, 2).alias("close_price"),
        X.to_dec("close_inr", 10, 2).alias("close_price_inr"),
        X.to_dec("daily_return_pct", 10, 2).alias("daily_return_local_pct"),
        X.exact_pct("close_inr", "prev_close_inr", 10, 10, 2).alias("daily_return_inr_pct"),
        X.to_dec("forex_rate", 10, 2).alias("forex_rate"),
        (F.when(F.col("_rate").isNotNull(), F.col("forex_pair")) if cfg.sp
         else F.col("forex_pair")).alias("currency_pair"))
