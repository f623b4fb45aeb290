"""Validation and monitoring jobs (V1–V10). Each returns a small DataFrame of findings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count (UNION ALL of counts)."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


def key_violations(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """V1 / V2: duplicated keys and rows with a NULL key column, in one aggregate pass."""
    has_null = None
    for k in keys:
        has_null = F.col(k).isNull() if has_null is None else (has_null | F.col(k).isNull())
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.lit(table).alias("table_name"),
                 F.sum((F.col("_c") > 1).cast("long")).alias("duplicate_keys"),
                 F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0)).alias("duplicate_rows"),
                 F.coalesce(F.sum(F.when(has_null, F.col("_c"))), F.lit(0)).alias("null_keys"))


def coverage(df: DataFrame, key: str, date_col: str = "trade_date") -> DataFrame:
    """V4: per key — row count, first and last date."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"),
                               F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))


def previous_trading_day(as_of: dt.date) -> dt.date:
    d = as_of - dt.timedelta(days=1)
    while d.weekday() >= 5:  # Saturday, Sunday
        d -= dt.timedelta(days=1)
    return d


def counts_against_expected(tables: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """V3: row count of each table against ``expected`` (table_name, expected_rows)."""
    return (row_counts(tables).join(expected, "table_name", "left")
            .select("table_name", "row_count", "expected_rows", F.col("row_count").eqNullSafe(F.col("expected_rows")).alias("as_expected")))


def freshness(df: DataFrame, key: str, as_of: dt.date, date_col: str = "trade_date") -> DataFrame:
    """V5: last date per key against the previous trading day before ``as_of`` — the day of the check, given by the
    caller: a feed that has stopped is behind it."""
    expected = previous_trading_day(as_of)
    return (df.groupBy(key).agg(F.max(date_col).alias("last_date"))
            .select(key, "last_date", F.lit(expected).alias("expected_date"),
                    F.datediff(F.lit(expected), F.col("last_date")).alias("days_behind"),
                    (F.col("last_date") >= F.lit(expected)).alias("is_fresh")))


def return_outliers(prices: DataFrame, low: float = -5.0, high: float = 5.0) -> DataFrame:
    """V6: per ticker, daily returns outside [low, high] percent."""
    r = F.col("daily_return_pct")
    return prices.groupBy("ticker").agg(
        F.count(r).alias("returns"),
        F.sum(((r < low) | (r > high)).cast("long")).alias("outside_range"),
        F.min(r).alias("min_return_pct"), F.max(r).alias("max_return_pct"))


def pair_count_check(corr: DataFrame, prices: DataFrame) -> DataFrame:
    """V7: correlation pairs against n(n−1)/2 for the tickers that have returns (one aggregate
    over the union of both inputs, no join)."""
    t = prices.where(F.col("daily_return_pct").isNotNull()).select(F.col("ticker"), F.lit(False).alias("_pair"))
    p = corr.select(F.lit(None).cast("string").alias("ticker"), F.lit(True).alias("_pair"))
    agg = t.unionByName(p).agg(F.countDistinct("ticker").alias("n"),
                               F.sum(F.col("_pair").cast("long")).alias("pairs"))
    expected = (F.col("n") * (F.col("n") - 1) / 2).cast("long")
    return agg.select("n", F.coalesce("pairs", F.lit(0)).alias("pairs"), expected.alias("expected_pairs"),
                      (F.coalesce("pairs", F.lit(0)) == expected).alias("complete"))


def home_rate_check(daily: DataFrame) -> DataFrame:
    """V8: home-currency rows (no FX pair) must carry rate 1."""
    home = F.col("currency_pair").isNull()
    return daily.agg(F.sum(home.cast("long")).alias("home_rows"),
                     F.sum((home & (F.col("forex_rate") != 1)).cast("long")).alias("bad_rate_rows"))


def unit_conversion_check(bronze_latest: DataFrame, silver: DataFrame, minor_units: dict[str, int]) -> DataFrame:
    """V9: per ticker quoted in a minor unit, silver close / bronze close (expected 1/divisor)."""
    b = bronze_latest.where(F.col("currency").isin(list(minor_units))).select(
        "ticker", "trade_date", "currency", F.col("close_price").alias("bronze_close"))
    j = b.join(silver.select("ticker", "trade_date", F.col("close_price").alias("silver_close")),
               ["ticker", "trade_date"], "inner")
    return j.groupBy("ticker", "currency").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(F.col("silver_close") / F.col("bronze_close")).alias("min_ratio"),
        F.max(F.col("silver_close") / F.col("bronze_close")).alias("max_ratio"))


def short_history_check(perf: DataFrame, stats: DataFrame) -> DataFrame:
    """Tickers without a year-ago price still get a return (earliest-price fallback)."""
    return (stats.where(F.col("year_ago_price").isNull())
            .join(perf.select("ticker", "yoy_return_pct"), "ticker", "inner")
            .select("ticker", "earliest_date", "yoy_return_pct",
                    F.col("yoy_return_pct").isNotNull().alias("has_return")))


def layer_listing(tables: dict[str, DataFrame], layer_of: dict[str, str]) -> DataFrame:
    """Each layer table with its row count and its columns in order
    (``listagg … WITHIN GROUP``; the group is one table's column list, bounded by its schema)."""
    spark = next(iter(tables.values())).sparkSession
    meta = spark.createDataFrame(
        [(layer_of.get(n), n, i, c) for n, df in tables.items() for i, c in enumerate(df.columns)],
        "layer string, table_name string, ordinal int, column_name string")
    cols = (meta.groupBy("layer", "table_name")
            .agg(F.count(F.lit(1)).alias("column_count"),
                 F.expr("listagg(column_name, ', ') WITHIN GROUP (ORDER BY ordinal)").alias("columns")))
    return (cols.join(row_counts(tables), "table_name", "inner")
            .select("layer", "table_name", "row_count", "column_count", "columns"))
