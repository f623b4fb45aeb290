"""Silver layer: cleaned bronze (M1–M4) and the planned cleaning steps."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantleaf import schemas
from quantleaf.functions import exprs as X
from quantleaf.operators.windows import latest_by_key, segmented_ffill, segmented_lag
from quantleaf.session import checkpointed

_CLOSE_DIGITS = 10
PRICE_COLS = ["open_price", "high_price", "low_price", "close_price"]


def _minor_factor(minor_units: dict[str, int], currency: Column) -> Column:
    """Multiplier from quoted units to major units; NULL when the currency is not minor."""
    if not minor_units:
        return F.lit(None).cast("decimal(10,6)")
    factors = {k: Decimal(1) / Decimal(v) for k, v in minor_units.items()}
    m = F.create_map(*[F.lit(x) for kv in factors.items() for x in kv])
    return m[currency]


def clean_prices(bronze: DataFrame, order_cols: list[str], minor_units: dict[str, int],
                 bucket_days: int = 90, cut_lineage: bool = False,
                 minor_units_by_ticker: dict[str, int] | None = None, digits: list[int] | None = None) -> DataFrame:
    """M1: latest fetch per (ticker, date), minor units → major, daily return.

    The return is the exact quotient of the converted, unrounded closes; stored prices and
    returns are DECIMAL(18,4). With ``cut_lineage`` the deduplicated rows are
    checkpointed once, so the two branches of the segmented LAG (rows and bucket
    tails) read them instead of deduplicating bronze twice.
    """
    b = bronze.withColumn("trade_date", F.col("trade_date").cast("date"))
    b = with_unit(b, minor_units, minor_units_by_ticker)
    dedup = latest_by_key(b, ["ticker", "trade_date"], order_cols, PRICE_PAYLOAD, digits)
    if cut_lineage:
        dedup = checkpointed(dedup)
    return price_returns(converted(dedup), bucket_days)


PRICE_PAYLOAD = [*PRICE_COLS, "volume", "_factor"]


def with_unit(bronze: DataFrame, minor_units: dict[str, int], minor_units_by_ticker: dict[str, int] | None = None) -> DataFrame:
    """Bronze prices with the factor from the quoted to the major unit: known before the dedupe, so that its payload is
    of fixed width and needs no sort."""
    factor = (_minor_factor(minor_units_by_ticker, F.col("ticker")) if minor_units_by_ticker
              else _minor_factor(minor_units, F.col("currency")))
    return bronze.withColumn("_factor", factor)


def converted(dedup: DataFrame) -> DataFrame:
    """Prices in major units; the close with 4 digits of the price and 6 of the unit."""
    factor = F.col("_factor")
    conv = dedup.select(
        "ticker", "trade_date", "volume",
        *[F.when(factor.isNotNull(), F.col(c) * factor).otherwise(F.col(c)).alias(c)
          for c in PRICE_COLS])
    return conv.withColumn("close_price", F.col("close_price").cast(f"decimal(28,{_CLOSE_DIGITS})"))


def price_returns(conv: DataFrame, bucket_days: int, tails: DataFrame | None = None) -> DataFrame:
    """Silver prices of converted rows: stored digits and the exact daily return. ``tails``: see ``segmented_lag``."""
    with_prev = segmented_lag(conv, ["ticker"], "trade_date", ["close_price"], bucket_days, tails=tails)
    return with_prev.select(
        "ticker", "trade_date",
        *[X.to_dec(c).alias(c) for c in PRICE_COLS],
        "volume",
        X.exact_pct("close_price", "prev_close_price", _CLOSE_DIGITS).alias("daily_return_pct"),
        F.lit(True).alias("is_valid"))


def clean_fundamentals(bronze: DataFrame, order_cols: list[str], digits: list[int] | None = None) -> DataFrame:
    """M2: latest fetch per ticker."""
    payload = ["report_date", *schemas.FUNDAMENTAL_COLUMNS]
    d = {f.name: f.dataType for f in schemas.BRONZE_FUNDAMENTALS.fields}
    latest = latest_by_key(bronze, ["ticker"], order_cols, payload, digits)
    return latest.select(
        "ticker", F.col("report_date").cast("date").alias("report_date"),
        *[F.col(c).cast(d[c]).alias(c) for c in schemas.FUNDAMENTAL_COLUMNS],
        F.lit(True).alias("is_valid"))


def known_quarters(bronze: DataFrame, known_on: list[dt.date], order_cols: list[str], payload: list[str], fetched_col: str = "fetched_on",
                   digits: list[int] | None = None) -> DataFrame:
    """M2 / M31 on two time axes: per ticker and quarter end, what was known on each day of ``known_on``: the latest fetch up
    to that day (known_on, ticker, quarter_end, payload). A row is copied once per day asked for, before a partial aggregate by
    key; quarters not yet fetched on a day are left out."""
    days = F.array(*[F.lit(d) for d in sorted(set(known_on))])
    rows = bronze.where(F.col("report_date").isNotNull()).withColumn("quarter_end", X.quarter_end("report_date"))
    rows = rows.withColumn("known_on", F.explode(F.filter(days, lambda d: d >= F.col(fetched_col))))
    return latest_by_key(rows, ["known_on", "ticker", "quarter_end"], order_cols, payload, digits)


def clean_forex(bronze: DataFrame, order_cols: list[str], bucket_days: int = 90,
                cut_lineage: bool = False, digits: list[int] | None = None) -> DataFrame:
    """M3: latest fetch per (pair, date), close only, daily change in percent."""
    b = bronze.withColumn("trade_date", F.col("trade_date").cast("date"))
    dedup = latest_by_key(b, ["currency_pair", "trade_date"], order_cols, ["close_rate"], digits)
    dedup = dedup.withColumn("close_rate", F.col("close_rate").cast(schemas.D18_6))
    if cut_lineage:
        dedup = checkpointed(dedup)
    with_prev = segmented_lag(dedup, ["currency_pair"], "trade_date", ["close_rate"], bucket_days)
    return with_prev.select(
        "currency_pair", "trade_date", "close_rate",
        X.exact_pct("close_rate", "prev_close_rate", 6, 18, 6).alias("daily_change_pct"),
        F.lit(True).alias("is_valid"))


def calendar_from_bounds(bounds: DataFrame, start_col: str = "start", end_col: str = "end",
                         holidays: DataFrame | None = None) -> DataFrame:
    """M4: one row per day between the bounds of each input row, with date attributes.

    ``holidays`` (a ``date_key`` column) optionally marks market holidays: they are
    not trading days (C21; the reference ignores holidays)."""
    days = bounds.select(F.explode(F.sequence(F.col(start_col), F.col(end_col))).alias("date_key"))
    d = F.col("date_key")
    dow = X.tsql_weekday(d)
    trading = ~dow.isin(1, 7)
    if holidays is not None:
        h = holidays.select("date_key").distinct().withColumn("_holiday", F.lit(True))
        days = days.join(h, "date_key", "left")
        trading = trading & F.col("_holiday").isNull()
    return days.select(
        d,
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        X.tsql_week(d).alias("week_number"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.year(d).alias("year"),
        dow.isin(1, 7).alias("is_weekend"),
        trading.alias("is_trading_day"))


def calendar(spark: SparkSession, start: dt.date, end: dt.date, holidays: DataFrame | None = None) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return calendar_from_bounds(bounds, holidays=holidays)


def calendar_for(prices: DataFrame) -> DataFrame:
    """Calendar spanning the first to the last trade date of ``prices``."""
    bounds = prices.agg(F.min("trade_date").alias("start"), F.max("trade_date").alias("end"))
    return calendar_from_bounds(bounds)


def forward_fill(df: DataFrame, keys: list[str], order_col: str, cols: list[str],
                 bucket_days: int = 90, flag_col: str | None = "is_valid") -> DataFrame:
    """Fill NULLs with the key's last known value; imputed rows get is_valid = false."""
    return segmented_ffill(df, keys, order_col, cols, bucket_days, flag_col)


def normalize_pairs(fx: DataFrame, base: str = "INR") -> DataFrame:
    """Express every pair as X/base. A pair quoted base/X is inverted."""
    parts = F.split(F.col("currency_pair"), "/")
    left, right = parts.getItem(0), parts.getItem(1)
    inverted = left == F.lit(base)
    rate = F.col("close_rate").cast("double")
    return fx.select(
        F.when(inverted, F.concat(right, F.lit("/"), left)).otherwise(F.col("currency_pair")).alias("currency_pair"),
        "trade_date",
        X.to_dec(F.when(inverted, 1.0 / F.nullif(rate, F.lit(0.0))).otherwise(rate), 18, 6).alias("close_rate"),
        inverted.alias("was_inverted"))


def standardize_quarter(df: DataFrame, date_col: str = "report_date",
                        out_col: str = "quarter_end_date") -> DataFrame:
    """Map a report date to its quarter end."""
    return df.withColumn(out_col, X.quarter_end(date_col))
