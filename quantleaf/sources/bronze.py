"""Bronze source scans with declared schemas (real deployments).

The three bronze tables are read from Parquet (or a catalog table) with their
declared StructTypes — no inference — and the dimensions from seed CSVs or the
built-in seed rows. The object matches the proxy bronze, so the same refresh
runs on either.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from quantleaf import schemas
from quantleaf.sources import seeds

# Latest fetch wins; the remaining columns break ties between fetches with the
# same timestamp deterministically (C4).
PRICE_FETCH_ORDER = ["api_fetched_at", "close_price", "volume", "open_price", "high_price", "low_price"]
FX_FETCH_ORDER = ["api_fetched_at", "close_rate"]
FUND_FETCH_ORDER = ["api_fetched_at", "market_cap", "report_date"]


def read_table(spark: SparkSession, location: str, schema) -> DataFrame:
    """A path is read as Parquet with the declared schema; a bare name is a catalog table."""
    if "/" in location or location.startswith("file:"):
        return spark.read.schema(schema).parquet(location)
    return spark.table(location)


class BronzeTables:
    price_order = PRICE_FETCH_ORDER
    fx_order = FX_FETCH_ORDER
    fund_order = FUND_FETCH_ORDER

    def __init__(self, spark: SparkSession, prices: str, fundamentals: str, forex: str,
                 companies_csv: str | None = None, currency_map_csv: str | None = None):
        self.prices = read_table(spark, prices, schemas.BRONZE_PRICES)
        self.fundamentals = read_table(spark, fundamentals, schemas.BRONZE_FUNDAMENTALS)
        self.forex = read_table(spark, forex, schemas.BRONZE_FOREX)
        self.companies = (seeds.companies_csv(spark, companies_csv) if companies_csv
                          else seeds.companies(spark))
        self.currency_map = (seeds.currency_map_csv(spark, currency_map_csv) if currency_map_csv
                             else seeds.currency_map(spark))


def load(spark: SparkSession, root: str, **kw) -> BronzeTables:
    """Bronze tables laid out as ``root/bronze_stock_prices`` etc."""
    return BronzeTables(spark, os.path.join(root, "bronze_stock_prices"),
                        os.path.join(root, "bronze_stock_fundamentals"),
                        os.path.join(root, "bronze_forex_rates"), **kw)
