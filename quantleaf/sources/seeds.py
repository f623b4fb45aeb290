"""Reference dimensions: companies and currency map.

The rows below are the reference's seed data, stated as fixed values. They are
dimension tables (a dozen rows); the engine reads them either from these
literals or from CSV files with the same header.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantleaf import schemas

# --- fixed values: the reference's seed rows, in their original order -------------
# companies: ticker, company_name, country, exchange, currency, category, region
COMPANY_ROWS = [
    ("CEG", "Constellation Energy Corporation", "USA", "NASDAQ", "USD", "Nuclear", "North America"),
    ("RR", "Rolls-Royce", "United Kingdom", "LSE", "GBP", "Nuclear", "Europe"),
    ("BHEL", "Bharat Heavy Electricals Limited", "India", "NSE", "INR", "Nuclear", "Asia"),
    ("MP", "MP Materials Corp", "USA", "NYSE", "USD", "Rare Earth Minerals", "North America"),
    ("RBW", "Rainbow Rare Earths Limited", "United Kingdom", "LSE", "GBP", "Rare Earth Minerals", "Europe"),
    ("GMDCLTD", "Gujarat Mineral Development Corporation", "India", "NSE", "INR", "Rare Earth Minerals", "Asia"),
    ("XOM", "Exxon Mobil Corporation", "USA", "NYSE", "USD", "Oil", "North America"),
    ("SHEL", "Shell PLC", "United Kingdom", "LSE", "GBP", "Oil", "Europe"),
    ("ONGC", "Oil and Natural Gas Corporation", "India", "NSE", "INR", "Oil", "Asia"),
    ("F", "Ford Motor Company", "USA", "NYSE", "USD", "Automotive", "North America"),
    ("VOW", "Volkswagen AG", "Germany", "XETRA", "EUR", "Automotive", "Europe"),
    ("TMPV", "Tata Motors Passenger Vehicles Limited", "India", "NSE", "INR", "Automotive", "Asia"),
]
# currency map: currency_code, currency_name, currency_country, forex_pair (None = home / no pair)
CURRENCY_ROWS = [
    ("USD", "US Dollar", "USA", "USD/INR"),
    ("GBP", "British Pound", "United Kingdom", "GBP/INR"),
    ("EUR", "Euro", "Germany", "EUR/INR"),
    ("INR", "Indian Rupee", "India", None),
    ("KRW", "South Korean Won", "South Korea", None),
]
# --- end of fixed values -----------------------------------------------------------


def literal_frame(spark: SparkSession, rows, schema) -> DataFrame:
    """A small literal table planned JVM-side in one partition (inline of an array of
    structs) instead of parallelising Python rows."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def companies(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, COMPANY_ROWS, schemas.COMPANIES)


def currency_map(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, CURRENCY_ROWS, schemas.CURRENCY_MAP)


def read_seed_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV seed with a header row; an empty field is NULL."""
    return (spark.read.option("header", True).option("nullValue", "")
            .option("emptyValue", None).schema(schema).csv(path))


def companies_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_seed_csv(spark, path, schemas.COMPANIES)


def currency_map_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_seed_csv(spark, path, schemas.CURRENCY_MAP)
