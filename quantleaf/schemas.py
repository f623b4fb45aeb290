"""Declared schemas of the bronze inputs and of the silver/gold outputs.

Column names follow the reference's table definitions; decimals keep their
declared precision so a BI tool reading the gold tables sees the same contract.
"""

from pyspark.sql import types as T

D18_4 = T.DecimalType(18, 4)
D18_6 = T.DecimalType(18, 6)


def _s(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


BRONZE_PRICES = _s(
    ("ticker", T.StringType(), False),
    ("trade_date", T.DateType(), False),
    ("open_price", D18_4, True),
    ("high_price", D18_4, True),
    ("low_price", D18_4, True),
    ("close_price", D18_4, True),
    ("volume", T.LongType(), True),
    ("exchange", T.StringType(), True),
    ("currency", T.StringType(), True),
    ("api_fetched_at", T.TimestampNTZType(), True),
)

BRONZE_FUNDAMENTALS = _s(
    ("ticker", T.StringType(), False),
    ("report_date", T.DateType(), True),
    ("market_cap", T.LongType(), True),
    ("pe_ratio", D18_4, True),
    ("pb_ratio", D18_4, True),
    ("dividend_yield", D18_6, True),
    ("dividend_per_share", D18_4, True),
    ("revenue", T.LongType(), True),
    ("net_profit", T.LongType(), True),
    ("roe", D18_4, True),
    ("debt_to_equity", D18_4, True),
    ("book_value", D18_4, True),
    ("shares_outstanding", T.LongType(), True),
    ("api_fetched_at", T.TimestampNTZType(), True),
)

BRONZE_FOREX = _s(
    ("currency_pair", T.StringType(), False),
    ("trade_date", T.DateType(), False),
    ("open_rate", D18_6, True),
    ("high_rate", D18_6, True),
    ("low_rate", D18_6, True),
    ("close_rate", D18_6, True),
    ("api_fetched_at", T.TimestampNTZType(), True),
)

COMPANIES = _s(
    ("ticker", T.StringType(), False),
    ("company_name", T.StringType(), True),
    ("country", T.StringType(), True),
    ("exchange", T.StringType(), True),
    ("currency", T.StringType(), True),
    ("category", T.StringType(), True),
    ("region", T.StringType(), True),
)

CURRENCY_MAP = _s(
    ("currency_code", T.StringType(), False),
    ("currency_name", T.StringType(), True),
    ("currency_country", T.StringType(), True),
    ("forex_pair", T.StringType(), True),
)

FUNDAMENTAL_COLUMNS = [
    "market_cap", "pe_ratio", "pb_ratio", "dividend_yield", "dividend_per_share",
    "revenue", "net_profit", "roe", "debt_to_equity", "book_value", "shares_outstanding",
]

# Landed ingestion payload (one JSON document per symbol and fetch); leaf values are strings.
PRICE_PAYLOAD = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("fetched_at", T.StringType()),
    T.StructField("values", T.ArrayType(T.StructType([
        T.StructField("datetime", T.StringType()),
        T.StructField("open", T.StringType()),
        T.StructField("high", T.StringType()),
        T.StructField("low", T.StringType()),
        T.StructField("close", T.StringType()),
        T.StructField("volume", T.StringType()),
    ]))),
])

# Landed FX payload: one document per pair and fetch; leaf values are strings.
FOREX_PAYLOAD = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("fetched_at", T.StringType()),
    T.StructField("values", T.ArrayType(T.StructType([
        T.StructField("datetime", T.StringType()),
        T.StructField("open", T.StringType()),
        T.StructField("high", T.StringType()),
        T.StructField("low", T.StringType()),
        T.StructField("close", T.StringType()),
    ]))),
])

# Landed fundamentals payload: one document per symbol and fetch, fields named as the
# bronze columns, values as strings.
FUNDAMENTALS_PAYLOAD = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("fetched_at", T.StringType()),
     T.StructField("report_date", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in FUNDAMENTAL_COLUMNS])


# --- fixed values: the dashboard's table contract (column names, order and types) ---
SILVER = {
    "silver_stock_prices": """ticker string, trade_date date, open_price decimal(18,4), high_price decimal(18,4), low_price decimal(18,4),
        close_price decimal(18,4), volume bigint, daily_return_pct decimal(18,4), is_valid boolean""",
    "silver_stock_fundamentals": """ticker string, report_date date, market_cap bigint, pe_ratio decimal(18,4), pb_ratio decimal(18,4),
        dividend_yield decimal(18,6), dividend_per_share decimal(18,4), revenue bigint, net_profit bigint, roe decimal(18,4),
        debt_to_equity decimal(18,4), book_value decimal(18,4), shares_outstanding bigint, is_valid boolean""",
    "silver_forex_rates": "currency_pair string, trade_date date, close_rate decimal(18,6), daily_change_pct decimal(18,6), is_valid boolean",
    "silver_companies": "ticker string, company_name string, country string, exchange string, currency string, category string, region string",
    "silver_currency_map": "currency_code string, currency_name string, currency_country string, forex_pair string",
}
GOLD = {
    "gold_stock_performance": """ticker string, company_name string, category string, region string, currency string,
        current_price decimal(18,4), yoy_return_pct decimal(18,4), week_52_high decimal(18,4), week_52_low decimal(18,4),
        volatility decimal(18,4), sharpe_ratio decimal(18,4), pe_ratio decimal(18,4), market_cap bigint, roe decimal(18,4),
        debt_to_equity decimal(18,4), dividend_yield decimal(18,6)""",
    "gold_currency_adjusted_returns": """ticker string, company_name string, category string, region string, original_currency string,
        return_local_pct decimal(18,4), inr_start_rate decimal(18,6), inr_end_rate decimal(18,6), return_inr_pct decimal(18,4),
        currency_impact_pct decimal(18,4)""",
    "gold_category_performance": """category string, average_yoy_return_pct decimal(18,4), avg_volatility decimal(18,4), best_stock string,
        worst_stock string, avg_pe_ratio decimal(18,4), total_market_cap bigint, avg_dividend_yield decimal(18,6)""",
    "gold_region_performance": """region string, avg_yoy_return_pct decimal(18,4), avg_volatility decimal(18,4), avg_sharpe_ratio decimal(18,4),
        stock_count int, best_category string, avg_currency_impact_pct decimal(18,4)""",
    "gold_dividend_analysis": """ticker string, company_name string, category string, region string, stock_price decimal(18,4),
        annual_dividend decimal(18,4), dividend_yield_pct decimal(18,6), payout_ratio decimal(18,4), dividend_in_inr decimal(18,4),
        pays_dividend boolean""",
    "gold_correlation_matrix": """stock_1 string, stock_2 string, stock_1_category string, stock_2_category string, stock_1_region string,
        stock_2_region string, correlation_coefficient decimal(18,4), relationship string""",
    "gold_daily_inr_returns": """ticker string, trade_date date, close_price decimal(10,2), close_price_inr decimal(10,2),
        daily_return_local_pct decimal(10,2), daily_return_inr_pct decimal(10,2), forex_rate decimal(10,2), currency_pair string""",
}
# --- end of fixed values -------------------------------------------------------------


def check_contract(name: str, df) -> None:
    """Raise if a silver or gold table would not have the columns and types that its readers expect."""
    declared = {**SILVER, **GOLD}.get(name)
    if declared is None:
        return
    want = [(c, t) for c, t in (part.split() for part in " ".join(declared.split()).replace("(18,", "(18;").replace("(10,", "(10;").split(", "))]
    want = [(c, t.replace(";", ",")) for c, t in want]
    if df.dtypes != want:
        raise ValueError(f"{name} breaks its contract: {sorted(set(df.dtypes) ^ set(want)) or 'column order'}")
