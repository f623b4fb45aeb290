"""M14 ingestion, re-aimed at landed payload files.

The reference fetches quotes over HTTP in a scheduled script and inserts only
rows newer than what bronze already holds. Here the fetcher's JSON responses
are files (or strings) that Spark parses with a declared schema; the
"newer than stored" check and the duplicate check are joins against bronze.
``check_payloads`` splits what landed into bronze rows and rejects: nothing vanishes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantleaf import schemas

# --- fixed values: vendor symbol conventions --------------------------------------
# database ticker → symbol used by both APIs
API_SYMBOL = {"VOW": "VOW3"}
# price API: database exchange → exchange code of the call (the symbol is bare)
PRICE_EXCHANGE = {"XETRA": "XETR"}
# fundamentals API: exchange → suffix of the symbol (no exchange in the call)
EXCHANGE_SUFFIX = {"LSE": ".L", "NSE": ".NS", "XETRA": ".DE"}
# --- end of fixed values -----------------------------------------------------------

_SUFFIX_RE = "(" + "|".join(s.replace(".", "\\.") for s in EXCHANGE_SUFFIX.values()) + ")$"


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    if not mapping:
        return key
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[key], key)


def price_symbol(ticker: Column) -> Column:
    """Database ticker → symbol of a price call (S7): the API symbol, without a suffix."""
    return _lookup(API_SYMBOL, ticker)


def price_exchange(exchange: Column) -> Column:
    """Database exchange → exchange code of a price call."""
    return _lookup(PRICE_EXCHANGE, exchange)


def exchange_of(code: Column) -> Column:
    """Exchange code of a price payload → database exchange."""
    return _lookup({v: k for k, v in PRICE_EXCHANGE.items()}, code)


def price_ticker(symbol: Column) -> Column:
    """Symbol of a price payload → database ticker: bare symbols, a dot belongs to the ticker."""
    return _lookup({v: k for k, v in API_SYMBOL.items()}, symbol)


def vendor_symbol(ticker: Column, exchange: Column) -> Column:
    """Database ticker → symbol of a fundamentals call (S7): API symbol plus exchange suffix."""
    suffix = F.create_map(*[F.lit(x) for kv in EXCHANGE_SUFFIX.items() for x in kv])[exchange]
    return F.concat(_lookup(API_SYMBOL, ticker), F.coalesce(suffix, F.lit("")))


def ticker_of(symbol: Column) -> Column:
    """Symbol of a fundamentals payload → database ticker (S7, F17): strip the suffix, undo the API symbol map."""
    bare = F.regexp_replace(symbol, _SUFFIX_RE, "")
    return _lookup({v: k for k, v in API_SYMBOL.items()}, bare)


def read_price_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON documents (one per line) with the declared payload schema."""
    return spark.read.schema(schemas.PRICE_PAYLOAD).json(path)


def payloads_from_strings(df: DataFrame, col: str = "value", schema=None) -> DataFrame:
    """S5 for payloads that arrive as JSON strings (a column of a table or a stream)."""
    return (df.select(F.from_json(F.col(col), schema or schemas.PRICE_PAYLOAD).alias("p"))
            .select("p.*"))


def parse_price_payloads(payloads: DataFrame, ingested_at=None) -> DataFrame:
    """Payload documents → bronze price rows (one per value entry). ``ingested_at`` (a timestamp) stands in where a
    document has no fetch time (S12); without it such rows have none."""
    d4 = schemas.D18_4
    v = payloads.select("symbol", "exchange", "currency", "fetched_at", F.explode("values").alias("v"))
    return v.select(
        price_ticker(F.col("symbol")).alias("ticker"),
        F.to_date(F.col("v.datetime")).alias("trade_date"),
        F.col("v.open").cast(d4).alias("open_price"),
        F.col("v.high").cast(d4).alias("high_price"),
        F.col("v.low").cast(d4).alias("low_price"),
        F.col("v.close").cast(d4).alias("close_price"),
        F.col("v.volume").cast("bigint").alias("volume"),
        exchange_of(F.col("exchange")).alias("exchange"), "currency",
        _fetched(ingested_at).alias("api_fetched_at"))


def _fetched(ingested_at=None, col: str = "fetched_at") -> Column:
    # The table default is the time of the ingest, which the caller passes in
    return F.coalesce(F.to_timestamp_ntz(F.col(col)), F.lit(ingested_at).cast("timestamp_ntz"))


def parse_forex_payloads(payloads: DataFrame, ingested_at=None) -> DataFrame:
    """FX payload documents (schemas.FOREX_PAYLOAD) → bronze FX rows."""
    d6 = schemas.D18_6
    v = payloads.select("symbol", "fetched_at", F.explode("values").alias("v"))
    return v.select(
        F.col("symbol").alias("currency_pair"),
        F.to_date(F.col("v.datetime")).alias("trade_date"),
        *[F.col(f"v.{k}").cast(d6).alias(f"{k}_rate") for k in ("open", "high", "low", "close")],
        _fetched(ingested_at).alias("api_fetched_at"))


def parse_fundamental_payloads(payloads: DataFrame, ingested_at=None) -> DataFrame:
    """Fundamentals payload documents (schemas.FUNDAMENTALS_PAYLOAD) → bronze rows;
    vendor symbols are mapped back to tickers."""
    types = {f.name: f.dataType for f in schemas.BRONZE_FUNDAMENTALS.fields}
    return payloads.select(
        ticker_of(F.col("symbol")).alias("ticker"),
        F.to_date(F.col("report_date")).alias("report_date"),
        *[F.col(c).cast(types[c]).alias(c) for c in schemas.FUNDAMENTAL_COLUMNS],
        _fetched(ingested_at).alias("api_fetched_at"))


# ------------------------------------------------------------------ accepted rows and rejects


@dataclass(frozen=True)
class Feed:
    """What a landed document holds: its schema, bronze key columns, and (source field, bronze column, type) of each entry.

    ``entries``: the fields are those of the entries of ``values``; else those of the document itself."""
    payload: T.StructType
    keys: Callable[[Column], list[Column]]
    fields: tuple[tuple[str, str, str], ...]
    entries: bool = True
    columns: tuple[str, ...] = ()


PRICE_FEED = Feed(
    schemas.PRICE_PAYLOAD,
    lambda p: [price_ticker(p["symbol"]).alias("ticker"), exchange_of(p["exchange"]).alias("exchange"), p["currency"].alias("currency")],
    (("datetime", "trade_date", "date"), ("open", "open_price", "decimal(18,4)"), ("high", "high_price", "decimal(18,4)"),
     ("low", "low_price", "decimal(18,4)"), ("close", "close_price", "decimal(18,4)"), ("volume", "volume", "bigint")),
    columns=tuple(schemas.BRONZE_PRICES.fieldNames()))
FOREX_FEED = Feed(
    schemas.FOREX_PAYLOAD, lambda p: [p["symbol"].alias("currency_pair")],
    (("datetime", "trade_date", "date"), *((k, f"{k}_rate", "decimal(18,6)") for k in ("open", "high", "low", "close"))),
    columns=tuple(schemas.BRONZE_FOREX.fieldNames()))
FUNDAMENTALS_FEED = Feed(
    schemas.FUNDAMENTALS_PAYLOAD, lambda p: [ticker_of(p["symbol"]).alias("ticker")],
    (("report_date", "report_date", "date"), *((f.name, f.name, f.dataType.simpleString()) for f in schemas.BRONZE_FUNDAMENTALS.fields
                                               if f.name in schemas.FUNDAMENTAL_COLUMNS)),
    entries=False, columns=tuple(schemas.BRONZE_FUNDAMENTALS.fieldNames()))


#: How documents are landed: compressed, as their field names and numbers in text are many times their content; a compressed file is
#: read by one task, so its documents are limited.
LANDED = {"compression": "gzip", "maxRecordsPerFile": "500000"}


def landed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Landed documents as text (``value``, one per line; blank lines are none) with the ``file`` they came from."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where("trim(value) != ''")


def check_payloads(raw: DataFrame, feed: Feed, ingested_at=None) -> DataFrame:
    """Every landed unit once: the bronze columns, with why it is rejected (``reasons``, empty: accepted), its text and file.

    A unit is an entry of a document's ``values``, or the document where it has no usable entries: broken JSON, an error
    response, no symbol, no values, a fetch time that is none. An entry is rejected for a missing or unreadable date and for each
    field that holds no number of its type; nothing is dropped and no cast fails, with ANSI on or off.
    ``raw``: value, file."""
    schema = T.StructType([*feed.payload.fields, T.StructField("status", T.StringType()), T.StructField("code", T.StringType()),
                           T.StructField("_corrupt", T.StringType())])
    docs = raw.select("value", "file", F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt"}).alias("p"))
    p = F.col("p")
    broken = p.isNull() | p["_corrupt"].isNotNull()
    error = (p["status"] == "error") | (p["code"].isNotNull() & p["symbol"].isNull())
    found = [(broken, "broken JSON"), (~broken & error, "error response"),
             (~broken & ~F.coalesce(error, F.lit(False)) & (F.coalesce(F.trim(p["symbol"]), F.lit("")) == ""), "no symbol"),
             (p["fetched_at"].isNotNull() & p["fetched_at"].try_cast("timestamp_ntz").isNull(), "bad fetched_at")]
    if feed.entries:
        found.append((~broken & ~F.coalesce(error, F.lit(False)) & (F.coalesce(F.size(p["values"]), F.lit(0)) < 1), "no values"))
    docs = docs.withColumn("_doc", _reasons(found))
    usable = F.size("_doc") == 0
    if feed.entries:
        units = docs.withColumn("v", F.explode_outer(F.when(usable, p["values"])))
        v, text = F.col("v"), F.when(usable, F.to_json("v")).otherwise(F.col("value"))
    else:
        units, v, text = docs, p, F.col("value")
    bad = [(usable & v.isNull(), "empty entry")]
    values = []
    for source, column, dtype in feed.fields:
        value = v[source].try_cast(dtype)
        unread = v[source].isNotNull() & value.isNull()
        if column == "trade_date":
            unread = unread | (v.isNotNull() & v[source].isNull())
        bad.append((usable & unread, f"bad {source}"))
        values.append(value.alias(column))
    fetched = F.coalesce(p["fetched_at"].try_cast("timestamp_ntz"), F.lit(ingested_at).cast("timestamp_ntz")).alias("api_fetched_at")
    rows = units.select(*feed.keys(p), *values, fetched, F.concat("_doc", _reasons(bad)).alias("reasons"),
                        F.when(~broken, p["symbol"]).alias("symbol"), text.alias("text"), "file")
    return rows.select(*feed.columns, "reasons", "symbol", "text", "file")


def _reasons(found: list[tuple[Column, str]]) -> Column:
    return F.filter(F.array(*[F.when(cond, F.lit(reason)) for cond, reason in found]), lambda r: r.isNotNull())


def accepted(checked: DataFrame, feed: Feed) -> DataFrame:
    """The bronze rows of the accepted units."""
    return checked.where(F.size("reasons") == 0).select(*feed.columns)


def rejects(checked: DataFrame) -> DataFrame:
    """symbol, reason, text, file of the rejected units."""
    return checked.where(F.size("reasons") > 0).select("symbol", F.concat_ws("; ", "reasons").alias("reason"), "text", "file")


def without_accepted_text(checked: DataFrame) -> DataFrame:
    """The units of ``check_payloads`` as the tables take them: only rejects keep their symbol, text and file."""
    rejected = F.size("reasons") > 0
    return checked.withColumns({c: F.when(rejected, F.col(c)) for c in ("symbol", "text", "file")})


def unit_counts(checked: DataFrame) -> DataFrame:
    """One row: how many units landed, were accepted and were rejected."""
    bad = (F.size("reasons") > 0).cast("long")
    return checked.agg(F.count(F.lit(1)).alias("landed"), F.coalesce(F.sum(1 - bad), F.lit(0)).alias("accepted"),
                       F.coalesce(F.sum(bad), F.lit(0)).alias("rejected"))


def newer_than_stored(stored: DataFrame, arriving: DataFrame, key: str = "ticker",
                      date_col: str = "trade_date") -> DataFrame:
    """Arriving rows dated after the latest stored date of their key (all rows of new keys).

    ``stored`` needs only (key, date) rows: full bronze, or — at scale — a small
    watermark table of the latest date per key (see ``streaming.incremental``)."""
    latest = stored.groupBy(key).agg(F.max(date_col).alias("_latest"))
    return (arriving.join(latest, key, "left")
            .where(F.col("_latest").isNull() | (F.col(date_col) > F.col("_latest")))
            .drop("_latest"))


def not_yet_stored(stored: DataFrame, arriving: DataFrame,
                   keys: tuple[str, ...] = ("ticker", "trade_date")) -> DataFrame:
    """Arriving rows whose key is not in bronze yet (duplicate check)."""
    return arriving.join(stored.select(*keys).distinct(), list(keys), "left_anti")
