"""Bronze-shaped inputs derived from the generated test tables.

The test data has no market data, so instruments, prices, FX rates and
fundamentals are projected out of the TPC-H-style tables:

* instruments are the part brands (``k`` = brand number); ``k % 5`` picks the
  region and currency, ``k % 4`` the category;
* one price row per lineitem on its ship date, quoted x100 for pence tickers;
  several lineitems on one (brand, date) are competing fetches of that day,
  ordered by (order key, line number, part key, supplier key);
* FX rates come from orders (order priority → pair, order date → trade date);
* fundamentals are one fetch per part of the brand.

Everything is a lazy DataFrame over the parquet scans, so the work grows with
the tables. The same derivation is written as SQL for the DuckDB oracle in
``quantleaf.plans.oracle``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantleaf import schemas
from quantleaf.sources import seeds

# Fetch-order columns of each proxy bronze table (latest fetch = largest tuple).
PRICE_FETCH_ORDER = ["fetch_seq", "l_linenumber", "l_partkey", "l_suppkey"]
FX_FETCH_ORDER = ["fetch_seq"]
FUND_FETCH_ORDER = ["fetch_seq"]

# --- fixed values of the proxy mapping -------------------------------------------
SHORT_HISTORY_TICKER = "Brand#6"
SHORT_HISTORY_START = "2001-04-18"
# brand number % 5 → price currency (pence for 3) and company currency
PRICE_CURRENCY = {1: "USD", 3: "GBp", 4: "EUR"}          # else INR
COMPANY_CURRENCY = {1: "USD", 3: "GBP", 4: "EUR"}        # else INR
EXCHANGE_OF = {"USD": "NYSE", "GBP": "LSE", "EUR": "XETRA", "INR": "NSE"}
# order priority → FX pair
PRIORITY_PAIR = {"1-URGENT": "USD/INR", "2-HIGH": "GBP/INR", "3-MEDIUM": "EUR/INR", "5-LOW": "JPY/INR"}  # else KRW/INR
# fundamentals: report dates over four years from this day
REPORTS_START, REPORT_DAYS = "1995-01-01", 1461
# --- end of fixed values -----------------------------------------------------------


class Bronze:
    """The bronze inputs; each table's plan is built on first use."""

    price_order = PRICE_FETCH_ORDER
    fx_order = FX_FETCH_ORDER
    fund_order = FUND_FETCH_ORDER
    order_digits = {"prices": [13, 2, 12, 10], "forex": [13], "fundamentals": [12]}      # enough for tables of 100 TB

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def prices(self) -> DataFrame:
        return bronze_prices(self.spark, self.sf_dir)

    @cached_property
    def fundamentals(self) -> DataFrame:
        return bronze_fundamentals(self.spark, self.sf_dir)

    @cached_property
    def forex(self) -> DataFrame:
        return bronze_forex(self.spark, self.sf_dir)

    @cached_property
    def companies(self) -> DataFrame:
        return companies(self.spark, self.sf_dir)

    @cached_property
    def currency_map(self) -> DataFrame:
        return seeds.currency_map(self.spark)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _brand_no(col: str = "p_brand") -> Column:
    return F.regexp_replace(F.col(col), "Brand#", "").cast("int")


def _dec(c: Column, dtype) -> Column:
    """double → DECIMAL in two exact steps: 8 digits (recovers the intended decimal
    value from binary noise), then half-up to the target scale. A direct cast of a
    double that sits next to a tie can round either way depending on the engine."""
    return c.cast("decimal(18,8)").cast(dtype)


def _by_mod(k: Column, mapping: dict[int, str], default: str) -> Column:
    expr = None
    for r, v in mapping.items():
        expr = F.when(k % 5 == r, F.lit(v)) if expr is None else expr.when(k % 5 == r, F.lit(v))
    return expr.otherwise(F.lit(default))


def bronze_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    # Per-brand attributes are derived on the part dimension, once per part, not per lineitem.
    k = _brand_no()
    part = _table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand",
        F.when(k % 5 == 3, F.lit(100)).otherwise(F.lit(1)).alias("_mult"),
        _by_mod(k, PRICE_CURRENCY, "INR").alias("currency"))
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    mult = F.col("_mult")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    trade_date = F.to_date("l_shipdate")
    d = schemas.D18_4
    return (j.select(
                F.col("p_brand").alias("ticker"),
                trade_date.alias("trade_date"),
                _dec(unit * (1 - F.col("l_discount") / 2) * mult, d).alias("open_price"),
                _dec(unit * (1 + F.col("l_tax")) * mult, d).alias("high_price"),
                _dec(unit * (1 - F.col("l_discount")) * mult, d).alias("low_price"),
                _dec(unit * mult, d).alias("close_price"),
                F.col("l_quantity").cast("bigint").alias("volume"),
                "currency",
                F.col("l_orderkey").alias("fetch_seq"),
                "l_linenumber", "l_partkey", "l_suppkey"))


def late_listing(prices: DataFrame) -> DataFrame:
    """Prices with one ticker listed late, for the short-history check only: no other query drops rows."""
    early = (F.col("ticker") == SHORT_HISTORY_TICKER) & (F.col("trade_date") < F.lit(SHORT_HISTORY_START).cast("date"))
    return prices.where(~early)


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = (_table(spark, sf_dir, "part").select("p_brand").distinct()
              .withColumn("k", _brand_no()))
    region = _table(spark, sf_dir, "region")
    cur = _by_mod(F.col("k"), COMPANY_CURRENCY, "INR")
    exch = F.create_map(*[F.lit(x) for kv in EXCHANGE_OF.items() for x in kv])
    return (brands.join(region, region.r_regionkey == F.col("k") % 5, "inner")
            .select(F.col("p_brand").alias("ticker"),
                    F.concat(F.lit("Company "), F.col("k").cast("string")).alias("company_name"),
                    F.col("r_name").alias("country"),
                    exch[cur].alias("exchange"),
                    cur.alias("currency"),
                    F.concat(F.lit("CAT_"), (F.col("k") % 4).cast("string")).alias("category"),
                    F.col("r_name").alias("region")))


def bronze_forex(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    pair = None
    for pr, p in PRIORITY_PAIR.items():
        c = F.col("o_orderpriority") == pr
        pair = F.when(c, F.lit(p)) if pair is None else pair.when(c, F.lit(p))
    pair = pair.otherwise(F.lit("KRW/INR"))
    rate = _dec(F.lit(20) + F.col("o_totalprice") / 10000, schemas.D18_6)
    return (o.select(pair.alias("currency_pair"),
                    F.to_date("o_orderdate").alias("trade_date"),
                    rate.alias("close_rate"),
                    F.col("o_orderkey").alias("fetch_seq")))


def bronze_fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    rp, sz, pk = F.col("p_retailprice"), F.col("p_size"), F.col("p_partkey")
    no_div = (pk % 5) < 2
    no_profit = (pk % 7) == 0
    d4, d6 = schemas.D18_4, schemas.D18_6
    return p.select(
        F.col("p_brand").alias("ticker"),
        pk.alias("fetch_seq"),
        F.date_add(F.lit(REPORTS_START).cast("date"), (pk % REPORT_DAYS).cast("int")).alias("report_date"),
        F.round(rp * sz * 1000000).cast("bigint").alias("market_cap"),
        _dec(rp / sz, d4).alias("pe_ratio"),
        _dec(sz / 10, d4).alias("pb_ratio"),
        _dec(F.when(no_div, F.lit(None)).otherwise(sz / 1000), d6).alias("dividend_yield"),
        _dec(F.when(no_div, F.lit(None)).otherwise(rp / 100), d4).alias("dividend_per_share"),
        F.when(no_profit, F.lit(None)).otherwise(F.round(rp * 1000).cast("bigint")).alias("revenue"),
        F.when(no_profit, F.lit(None)).otherwise(F.round(rp * 100).cast("bigint")).alias("net_profit"),
        _dec(sz / 2, d4).alias("roe"),
        _dec(sz / 25, d4).alias("debt_to_equity"),
        _dec(rp / 2, d4).alias("book_value"),
        (sz * 1000).cast("bigint").alias("shares_outstanding"))


def load(spark: SparkSession, sf_dir: str) -> Bronze:
    return Bronze(spark, sf_dir)
