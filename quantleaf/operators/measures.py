"""Dashboard measures (M15–M28, M32) as parameterised DataFrame functions.

The reference evaluates these as DAX measures in a report's filter context; here
the filter context is explicit: slicer values are filter arguments and the
visual's axes are grouping keys. Period measures read the daily home-currency
series (``gold_daily_inr_returns``), point-in-time measures read the gold tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantleaf.functions import exprs as X
from quantleaf.operators.ranking import rank_by
from quantleaf.session import checkpointed


def _period(grain: str, d: Column) -> Column:
    if grain == "year":
        return F.year(d)
    if grain == "quarter":
        return F.year(d) * 10 + F.quarter(d)
    if grain == "month":
        return F.year(d) * 100 + F.month(d)
    raise ValueError(f"unknown period grain {grain!r}")


def slice_daily(daily: DataFrame, tickers: Sequence[str] | None = None,
                years: Sequence[int] | None = None, start=None, end=None) -> DataFrame:
    """P14 slicers: ticker list, year list, date range (all optional)."""
    out = daily
    if tickers:
        out = out.where(F.col("ticker").isin(list(tickers)))
    if years:
        out = out.where(F.year("trade_date").isin(list(years)))
    if start is not None:
        out = out.where(F.col("trade_date") >= F.lit(start))
    if end is not None:
        out = out.where(F.col("trade_date") <= F.lit(end))
    return out


def slice_category(daily: DataFrame, companies: DataFrame, categories: Sequence[str]) -> DataFrame:
    """The category slicer filters the dimension, which filters the series."""
    chosen = companies.where(F.col("category").isin(list(categories))).select("ticker")
    return daily.join(chosen, "ticker", "left_semi")


def leading_categories(perf: DataFrame, n: int = 3) -> DataFrame:
    """T5: the ``n`` categories with the highest average return, ordered by the aggregate — the limit is the feature."""
    return (perf.groupBy("category").agg(F.avg("yoy_return_pct").alias("_avg"), F.count("yoy_return_pct").alias("stocks"))
            .orderBy(F.col("_avg").desc_nulls_last(), "category").limit(n)
            .select("category", X.to_dec("_avg").alias("avg_yoy_return_pct"), "stocks"))


def period_returns(daily: DataFrame, grain: str = "year") -> DataFrame:
    """Local and home-currency return from the first to the last close of each
    (period, ticker), and the currency effect (FIRSTDATE/LASTDATE in context)."""
    d = F.col("trade_date")
    g = (daily.withColumn("period", _period(grain, d))
         .groupBy("period", "ticker")
         .agg(F.min_by("close_price", d).alias("first_close"),
              F.max_by("close_price", d).alias("last_close"),
              F.min_by("close_price_inr", d).alias("first_close_inr"),
              F.max_by("close_price_inr", d).alias("last_close_inr")))
    return returns_of_periods(g)


def returns_of_periods(g: DataFrame) -> DataFrame:
    """M15–M17 of rows (period, ticker, first and last close in both currencies)."""
    local = X.exact_pct("last_close", "first_close", 4)
    inr = X.exact_pct("last_close_inr", "first_close_inr", 4)
    return g.select(F.col("period").cast("int").alias("period"), "ticker", "first_close", "last_close",
                    local.alias("local_return_pct"), inr.alias("inr_return_pct"),
                    X.to_dec(inr - local).alias("currency_impact_pct"))


def category_period_returns(daily: DataFrame, companies: DataFrame, grain: str = "year") -> DataFrame:
    """Per-ticker period return first, then the average over the category's tickers."""
    pr = period_returns(daily, grain).join(companies.select("ticker", "category"), "ticker", "inner")
    return (pr.groupBy("period", "category")
            .agg(X.to_dec(F.avg("local_return_pct")).alias("avg_local_return_pct"),
                 X.to_dec(F.avg("inr_return_pct")).alias("avg_inr_return_pct"),
                 F.count(F.lit(1)).alias("ticker_count")))


def category_period_volatility(daily: DataFrame, companies: DataFrame, grain: str = "year") -> DataFrame:
    """Population stdev of each ticker's daily returns in the period, averaged per category."""
    per = (daily.withColumn("period", _period(grain, F.col("trade_date")))
           .groupBy("period", "ticker")
           .agg(X.to_dec(F.stddev_pop("daily_return_local_pct")).alias("volatility")))
    return average_volatility(per, companies)


def average_volatility(per: DataFrame, companies: DataFrame) -> DataFrame:
    """The average of the tickers' volatility (period, ticker, volatility) per category."""
    return (per.join(companies.select("ticker", "category"), "ticker", "inner")
            .groupBy("period", "category")
            .agg(X.to_dec(F.avg("volatility")).alias("avg_volatility"),
                 F.count("volatility").alias("ticker_count")))


def best_worst_stock(daily: DataFrame, companies: DataFrame, grain: str = "year",
                     measure: str = "local_return_pct") -> DataFrame:
    """TOPN(1) best and worst ticker per (period, category); ties are all kept."""
    # One row per (period, ticker), stored once: the series is scanned once, not for every use below.
    pr = checkpointed(period_returns(daily, grain).join(companies.select("ticker", "category"), "ticker", "inner")
                      .where(F.col(measure).isNotNull())
                      .select("period", "category", "ticker", F.col(measure).alias("return_pct")))
    ends = pr.groupBy("period", "category").agg(F.max("return_pct").alias("_hi"), F.min("return_pct").alias("_lo"))
    kinds = F.filter(F.array(F.when(F.col("return_pct") == F.col("_hi"), F.lit("best")),
                             F.when(F.col("return_pct") == F.col("_lo"), F.lit("worst"))), lambda k: k.isNotNull())
    return (pr.join(ends, ["period", "category"], "inner").withColumn("kind", F.explode(kinds))
            .select("period", "category", "kind", "ticker", "return_pct"))


def dynamic_dividend_yield(daily: DataFrame, fundamentals: DataFrame, grain: str = "year") -> DataFrame:
    """Dividend per share over the last close of the period, in percent."""
    d = F.col("trade_date")
    last = (daily.withColumn("period", _period(grain, d)).groupBy("period", "ticker")
            .agg(F.max_by("close_price", d).alias("last_close")))
    f = fundamentals.select("ticker", "dividend_per_share")
    j = last.join(f, "ticker", "inner")
    return j.select("period", "ticker", "last_close", "dividend_per_share",
                    X.to_dec(X.safe_div("dividend_per_share", "last_close") * 100, 18, 6).alias("dividend_yield_pct"))


DEFAULT_AMOUNTS = (10000, 50000, 100000, 500000)
DEFAULT_TAX_RATES = ("0", "0.1", "0.15", "0.2", "0.3")


def scenario_returns(returns: DataFrame, return_col: str = "return_inr_pct",
                     amounts: Sequence = DEFAULT_AMOUNTS, tax_rates: Sequence = DEFAULT_TAX_RATES) -> DataFrame:
    """M22 what-if grid: every (amount, tax rate) for every ticker's return.

    gross = amount · r/100, tax = max(gross, 0) · rate, net = gross − tax,
    final = amount + net; exact decimal arithmetic. The grid is a parameter-sized
    generator on each row (explode), not a join.
    """
    amt = F.explode(F.array(*[F.lit(Decimal(str(a))).cast("decimal(12,2)") for a in amounts])).alias("amount")
    rates = F.explode(F.array(*[F.lit(Decimal(str(t))).cast("decimal(5,4)") for t in tax_rates])).alias("tax_rate")
    r = F.col(return_col).cast("decimal(18,4)")
    g = returns.where(F.col(return_col).isNotNull()).select("ticker", r.alias("return_pct")).select("*", amt).select("*", rates)
    gross = F.col("amount") * F.col("return_pct") * F.lit(Decimal("0.01"))
    tax = F.greatest(gross, F.lit(0).cast("decimal(1,0)")) * F.col("tax_rate")
    return g.select("ticker", "return_pct", "amount", "tax_rate",
                    gross.cast("decimal(18,2)").alias("gross_gain"),
                    tax.cast("decimal(18,2)").alias("tax"),
                    (gross - tax).cast("decimal(18,2)").alias("net_gain"),
                    (F.col("amount") + gross - tax).cast("decimal(18,2)").alias("final_value"))


def week52_position(perf: DataFrame) -> DataFrame:
    """Where the current price sits in the 52-week range, in percent."""
    pos = X.safe_div(F.col("current_price") - F.col("week_52_low"), F.col("week_52_high") - F.col("week_52_low")) * 100
    return perf.select("ticker", "current_price", "week_52_low", "week_52_high",
                       X.to_dec(pos).alias("position_pct"))


def yoy_comparison(perf: DataFrame) -> DataFrame:
    """Rank of each stock's YoY return within its category (ties share a rank)."""
    base = perf.select("category", "ticker", "yoy_return_pct")
    return rank_by(base, "yoy_return_pct", ["category"], descending=True, out="category_rank")


def dividend_ranking(div: DataFrame) -> DataFrame:
    """Stocks ordered by dividend yield (rank 1 = highest)."""
    base = div.select("ticker", "company_name", "dividend_yield_pct", "annual_dividend", "pays_dividend")
    return rank_by(base, "dividend_yield_pct", None, descending=True, out="yield_rank")


def sharpe_ranking(perf: DataFrame, risk_free: float = 0.0) -> DataFrame:
    """(return − risk-free) / volatility, ranked (rank 1 = best)."""
    vol = F.col("volatility")
    s = F.when(vol.isNull() | (vol == 0), F.lit(None)).otherwise(
        (F.col("yoy_return_pct").cast("double") - F.lit(float(risk_free))) / vol.cast("double"))
    base = perf.select("ticker", "yoy_return_pct", "volatility", X.to_dec(s).alias("sharpe"))
    return rank_by(base, "sharpe", None, descending=True, out="sharpe_rank")


def price_volume_series(prices: DataFrame, tickers: Sequence[str] | None = None, start=None, end=None) -> DataFrame:
    """Close and volume by date (range-partitioned global sort)."""
    return (slice_daily(prices, tickers, None, start, end)
            .select("ticker", "trade_date", "close_price", "volume")
            .orderBy("ticker", "trade_date"))


def forex_trend(fx: DataFrame, pairs: Sequence[str] | None = None, start=None, end=None) -> DataFrame:
    """Rate and daily change series per pair."""
    out = fx
    if pairs:
        out = out.where(F.col("currency_pair").isin(list(pairs)))
    if start is not None:
        out = out.where(F.col("trade_date") >= F.lit(start))
    if end is not None:
        out = out.where(F.col("trade_date") <= F.lit(end))
    return out.select("currency_pair", "trade_date", "close_rate", "daily_change_pct").orderBy("currency_pair", "trade_date")


def top_latest(df: DataFrame, n: int = 5, order_col: str = "trade_date",
               tie_cols: Sequence[str] = ("ticker",)) -> DataFrame:
    """The ``n`` most recent rows (TOP n … ORDER BY date DESC) — the limit is the feature.
    Planned as TakeOrderedAndProject: each task keeps its own top n, the driver merges n per task."""
    return df.orderBy(F.col(order_col).desc(), *[F.col(c) for c in tie_cols]).limit(n)


def single_stock_metrics(stats: DataFrame, companies: DataFrame, fundamentals: DataFrame) -> DataFrame:
    """One wide row per stock answering the single-stock questions."""
    f = fundamentals.select("ticker", "market_cap", "pe_ratio", "pb_ratio", "roe", "debt_to_equity",
                            "book_value", "revenue", "net_profit", "dividend_per_share", "dividend_yield")
    j = (companies.select("ticker", "company_name", "category", "region", "currency")
         .join(stats, "ticker", "left").join(f, "ticker", "left"))
    return j.select("ticker", "company_name", "category", "region", "currency",
                    X.to_dec("current_price").alias("current_price"),
                    X.to_dec("week_52_high").alias("week_52_high"),
                    X.to_dec("week_52_low").alias("week_52_low"),
                    X.to_dec("yoy_raw").alias("yoy_return_pct"),
                    F.col("latest_volume"),
                    "market_cap", "pe_ratio", "pb_ratio", "roe", "debt_to_equity", "book_value",
                    "revenue", "net_profit", "dividend_per_share", "dividend_yield",
                    "volatility")
