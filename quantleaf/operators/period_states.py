"""Mergeable period states (M15–M19, G15, P14): a stored roll-up per ticker and month that answers any date range.

A state holds the first and last day with their closes, the number of rows, and count, sum and sum of squares of the daily
returns in exact decimals. States merge by minimum, maximum and addition, so a range is the whole months in it from the roll-up,
plus the months that the range cuts, rolled up from their rows: at most two months of the daily table are read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantleaf.functions import exprs as X
from quantleaf.operators import measures as M

_FIRST = ["close_price", "close_price_inr"]


def month_states(daily: DataFrame) -> DataFrame:
    """One row per ticker and month (its first day): the state of the daily home-currency rows."""
    d, r = F.col("trade_date"), F.col("daily_return_local_pct")
    return daily.groupBy("ticker", F.trunc("trade_date", "month").alias("month")).agg(
        F.min(d).alias("first_date"), F.max(d).alias("last_date"),
        *[F.min_by(c, d).alias(f"first_{c}") for c in _FIRST], *[F.max_by(c, d).alias(f"last_{c}") for c in _FIRST],
        F.count(F.lit(1)).alias("rows"), F.count(r).alias("returns"),
        F.coalesce(F.sum(r.cast("decimal(28,2)")), F.lit(0)).cast("decimal(38,2)").alias("sum_return"),
        F.coalesce(F.sum((r * r).cast("decimal(28,4)")), F.lit(0)).cast("decimal(38,4)").alias("sum_square"))


def merge(states: DataFrame, *keys: Column | str) -> DataFrame:
    """The states of each group of ``keys`` (columns of the states, or expressions) as one."""
    first, last = F.col("first_date"), F.col("last_date")
    return states.groupBy(*keys).agg(
        *[F.min_by(f"first_{c}", first).alias(f"first_{c}") for c in _FIRST], *[F.max_by(f"last_{c}", last).alias(f"last_{c}") for c in _FIRST],
        F.min(first).alias("first_date"), F.max(last).alias("last_date"), F.sum("rows").alias("rows"), F.sum("returns").alias("returns"),
        F.sum("sum_return").alias("sum_return"), F.sum("sum_square").alias("sum_square"))


def of_range(states: DataFrame, daily: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """States that make up the range ``start`` … ``end``: stored ones of whole months, and of the cut months from rows of ``daily``."""
    head = start.replace(day=1)
    tail = end.replace(day=1)
    first_whole = head if start == head else _next_month(head)
    last_whole = tail if _next_month(tail) == end + dt.timedelta(days=1) else tail - dt.timedelta(days=1)      # months up to it are whole
    whole = states.where((F.col("month") >= F.lit(first_whole)) & (F.col("month") <= F.lit(last_whole.replace(day=1))))
    d = F.col("trade_date")
    cut = (d >= F.lit(start)) & (d <= F.lit(end)) & ((d < F.lit(first_whole)) | (d > F.lit(_last_day(last_whole))))
    return whole.unionByName(month_states(daily.where(cut)))


def _next_month(day: dt.date) -> dt.date:
    return (day.replace(day=1) + dt.timedelta(days=32)).replace(day=1)


def _last_day(day: dt.date) -> dt.date:
    return _next_month(day) - dt.timedelta(days=1)


def period_returns(states: DataFrame, grain: str = "year") -> DataFrame:
    """M15–M17 from states: as ``measures.period_returns`` gives them from the rows."""
    g = merge(states, M._period(grain, F.col("month")).alias("period"), "ticker")
    return M.returns_of_periods(g.select("period", "ticker", F.col("first_close_price").alias("first_close"), F.col("last_close_price").alias("last_close"),
                                         F.col("first_close_price_inr").alias("first_close_inr"), F.col("last_close_price_inr").alias("last_close_inr")))


def category_volatility(states: DataFrame, companies: DataFrame, grain: str = "year") -> DataFrame:
    """M19 from states: population deviation of each ticker's daily returns, averaged per category."""
    g = merge(states, M._period(grain, F.col("month")).alias("period"), "ticker")
    n = F.col("returns").cast("decimal(18,0)")
    squares = (n * F.col("sum_square") - F.col("sum_return") * F.col("sum_return")).cast("double")       # exact up to here
    deviation = F.when(n > 0, F.sqrt(squares) / n.cast("double"))
    per = g.select("period", "ticker", X.to_dec(deviation).alias("volatility"))
    return M.average_volatility(per, companies)
