"""Trading-day arithmetic (M4, V5, C21): every exchange's days are numbered, so "n trading days before" is an equality join.

``trading_calendar`` has one row per exchange and calendar day: whether it is a trading day (no weekend, no holiday of that
exchange) and the ordinal of the last trading day up to it. It is a dimension: its size is exchanges times days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantleaf.functions import exprs as X


def trading_calendar(exchanges: DataFrame, holidays: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """exchange, date_key, is_trading_day, ordinal (1 at the exchange's first trading day from ``start``; 0 before it).

    ``exchanges``: exchange; ``holidays``: exchange, date_key (repeated rows count once)."""
    days = exchanges.select("exchange").distinct().withColumn("date_key", F.explode(F.sequence(F.lit(start), F.lit(end))))
    marked = days.join(holidays.select("exchange", "date_key").distinct().withColumn("_holiday", F.lit(True)), ["exchange", "date_key"], "left")
    trading = ~X.tsql_weekday("date_key").isin(1, 7) & F.col("_holiday").isNull()
    w = Window.partitionBy("exchange").orderBy("date_key").rowsBetween(Window.unboundedPreceding, 0)
    return marked.select("exchange", "date_key", trading.alias("is_trading_day")).withColumn(
        "ordinal", F.sum(F.col("is_trading_day").cast("int")).over(w).cast("int"))


def trading_days_before(rows: DataFrame, calendar: DataFrame, n: int, date_col: str, out_col: str) -> DataFrame:
    """``rows`` (exchange, ``date_col``, ...) with the trading day that lies ``n`` trading days before the date; n = 0: the
    date itself or the last trading day before it. NULL where the calendar does not reach that far."""
    at = calendar.select("exchange", F.col("date_key").alias(date_col), F.col("ordinal").alias("_at"))
    target = calendar.where("is_trading_day").select("exchange", F.col("ordinal").alias("_target"), F.col("date_key").alias(out_col))
    return (rows.join(at, ["exchange", date_col], "left").withColumn("_target", F.col("_at") - n)
            .join(target, ["exchange", "_target"], "left").select(*rows.columns, out_col))


def freshness_by_exchange(prices: DataFrame, companies: DataFrame, calendar: DataFrame, as_of: dt.date) -> DataFrame:
    """V5: per ticker, the last date up to ``as_of``, the last trading day of its exchange before ``as_of`` (holidays count as closed),
    how many trading days it is behind (NULL without a price), and whether it is fresh."""
    # the day before as_of, or the last trading day before that
    before = calendar.where(F.col("date_key") == F.date_sub(F.lit(as_of), 1)).select("exchange", F.col("ordinal").alias("_due"))
    trading = calendar.where("is_trading_day").select("exchange", F.col("ordinal").alias("_due"), F.col("date_key").alias("expected_date"))
    due = before.join(trading, ["exchange", "_due"], "left")
    last = prices.where(F.col("trade_date") <= F.lit(as_of)).groupBy("ticker").agg(F.max("trade_date").alias("last_date"))
    at = calendar.select("exchange", F.col("date_key").alias("last_date"), F.col("ordinal").alias("_last"))
    rows = companies.select("ticker", "exchange").join(last, "ticker", "left").join(at, ["exchange", "last_date"], "left").join(due, "exchange", "left")
    return rows.select("ticker", "exchange", "last_date", "expected_date", F.when(F.col("_last").isNotNull(), F.greatest(F.col("_due") - F.col("_last"), F.lit(0))).alias("trading_days_behind"),
                       F.coalesce(F.col("last_date") >= F.col("expected_date"), F.lit(False)).alias("is_fresh"))


def trading_gaps(prices: DataFrame, companies: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per ticker: its first and last date, the trading days of its exchange from one to the other, those with a price, those
    without, and prices on days when the exchange was closed."""
    on = prices.select("ticker", "trade_date").join(companies.select("ticker", "exchange"), "ticker").join(
        calendar.select("exchange", F.col("date_key").alias("trade_date"), "is_trading_day", "ordinal"), ["exchange", "trade_date"], "left")
    open_ = F.col("is_trading_day").cast("long")
    g = on.groupBy("ticker", "exchange").agg(
        F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"), F.sum(open_).alias("priced_days"),
        F.sum(1 - open_).alias("closed_day_prices"), F.min(F.col("ordinal") - open_).alias("_before"), F.max("ordinal").alias("_last"))
    span = (F.col("_last") - F.col("_before")).cast("long")
    return g.select("ticker", "exchange", "first_date", "last_date", span.alias("trading_days"), "priced_days",
                    (span - F.col("priced_days")).alias("missing_days"), "closed_day_prices")
