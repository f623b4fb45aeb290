"""SQL building blocks for the DuckDB oracle.

The oracle recomputes every registered query with plain SQL over the same
parquet tables (views ``lineitem``, ``part``, ``orders``, ``region`` …). The
proxy bronze derivation and the silver layer are shared CTEs; each query adds
its own tail.

Numeric conventions shared with the Spark side:
* prices, rates and returns are exact DECIMALs: a return is a quotient of integers (HUGEINT), rounded half
  away from zero to the digits of its column;
* averages of decimals use exact half-up rounding of SUM/COUNT (DuckDB's AVG
  on DECIMAL goes through DOUBLE and would round ties differently).
"""

from __future__ import annotations

from quantleaf.sources.seeds import CURRENCY_ROWS


def avg_dec(expr: str, scale: int, out: str | None = None) -> str:
    """Exact AVG(decimal expr) rounded half away from zero to ``scale`` digits."""
    n = f"COUNT({expr})"
    s = f"CAST(SUM({expr}) * {10 ** scale} AS HUGEINT)"
    q = f"(SIGN({s}) * ((2 * ABS({s}) + {n}) // (2 * {n})))"
    body = (f"CASE WHEN {n} = 0 THEN NULL ELSE "
            f"CAST(CAST({q} AS DECIMAL(38,0)) * CAST({10.0 ** -scale:.{scale}f} AS DECIMAL({scale + 1},{scale})) "
            f"AS DECIMAL(18,{scale})) END")
    return body if out is None else f"{body} AS {out}"


def whole(expr: str, scale: int) -> str:
    """A decimal with at most ``scale`` fraction digits as HUGEINT."""
    return f"CAST(CAST({expr} AS DECIMAL(28,{scale})) * {10 ** scale} AS HUGEINT)"


def quotient(num: str, den: str, scale: int = 4, precision: int = 18) -> str:
    """num / den of HUGEINTs (num scaled by 10^scale), rounded half away from zero; NULL for a zero divisor."""
    q = f"SIGN({num}) * SIGN({den}) * ((2 * ABS({num}) + ABS({den})) // NULLIF(2 * ABS({den}), 0))"
    return f"CAST(CAST({q} AS DECIMAL(38,0)) * CAST({10.0 ** -scale:.{scale}f} AS DECIMAL({scale + 1},{scale})) AS DECIMAL({precision},{scale}))"


def pct(new: str, old: str, digits: int, scale: int = 4, precision: int = 18) -> str:
    """(new - old) / old * 100, exact."""
    return quotient(f"(({whole(new, digits)} - {whole(old, digits)}) * {10 ** (scale + 2)})", whole(old, digits), scale, precision)


BRONZE_PRICES = """
bronze_prices AS (
  SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS trade_date,
         CAST(CAST((l_extendedprice / l_quantity) * (1 - l_discount / 2) * m AS DECIMAL(18,8)) AS DECIMAL(18,4)) AS open_price,
         CAST(CAST((l_extendedprice / l_quantity) * (1 + l_tax) * m AS DECIMAL(18,8)) AS DECIMAL(18,4)) AS high_price,
         CAST(CAST((l_extendedprice / l_quantity) * (1 - l_discount) * m AS DECIMAL(18,8)) AS DECIMAL(18,4)) AS low_price,
         CAST(CAST((l_extendedprice / l_quantity) * m AS DECIMAL(18,8)) AS DECIMAL(18,4)) AS close_price,
         CAST(l_quantity AS BIGINT) AS volume,
         CASE k % 5 WHEN 1 THEN 'USD' WHEN 3 THEN 'GBp' WHEN 4 THEN 'EUR' ELSE 'INR' END AS currency,
         l_orderkey AS fetch_seq, l_linenumber, l_partkey, l_suppkey
  FROM (SELECT *, CASE WHEN k % 5 = 3 THEN 100 ELSE 1 END AS m
        FROM (SELECT l.*, p.p_brand, CAST(replace(p.p_brand, 'Brand#', '') AS INT) AS k
              FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey) a) b
)"""

COMPANIES = """
companies AS (
  SELECT b.p_brand AS ticker, 'Company ' || CAST(b.k AS VARCHAR) AS company_name,
         r.r_name AS country,
         CASE b.k % 5 WHEN 1 THEN 'NYSE' WHEN 3 THEN 'LSE' WHEN 4 THEN 'XETRA' ELSE 'NSE' END AS exchange,
         CASE b.k % 5 WHEN 1 THEN 'USD' WHEN 3 THEN 'GBP' WHEN 4 THEN 'EUR' ELSE 'INR' END AS currency,
         concat('CAT_', CAST(b.k % 4 AS VARCHAR)) AS category, r.r_name AS region
  FROM (SELECT DISTINCT p_brand, CAST(replace(p_brand, 'Brand#', '') AS INT) AS k FROM part) b
  JOIN region r ON r.r_regionkey = b.k % 5
)"""

def _currency_map_sql() -> str:
    """The seed rows of ``sources/seeds.py`` as VALUES."""
    quoted = lambda v: "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    rows = ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in CURRENCY_ROWS)
    return f"\ncurrency_map AS (SELECT * FROM (VALUES {rows}) t(currency_code, currency_name, currency_country, forex_pair))"


CURRENCY_MAP = _currency_map_sql()

BRONZE_FOREX = """
bronze_forex AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'USD/INR' WHEN '2-HIGH' THEN 'GBP/INR'
                              WHEN '3-MEDIUM' THEN 'EUR/INR' WHEN '5-LOW' THEN 'JPY/INR' ELSE 'KRW/INR' END AS currency_pair,
         CAST(o_orderdate AS DATE) AS trade_date,
         CAST(CAST(20 + o_totalprice / 10000 AS DECIMAL(18,8)) AS DECIMAL(18,6)) AS close_rate, o_orderkey AS fetch_seq
  FROM orders
)"""

BRONZE_FUND = """
bronze_fund AS (
  SELECT p_brand AS ticker, p_partkey AS fetch_seq, CAST(DATE '1995-01-01' + CAST(p_partkey % 1461 AS INTEGER) AS DATE) AS report_date,
         CAST(round(p_retailprice * p_size * 1000000) AS BIGINT) AS market_cap,
         CAST(CAST(p_retailprice / p_size AS DECIMAL(18,8)) AS DECIMAL(18,4)) AS pe_ratio,
         CAST(CAST(p_size / 10 AS DECIMAL(18,8)) AS DECIMAL(18,4)) AS pb_ratio,
         CAST(CAST(CASE WHEN p_partkey % 5 < 2 THEN NULL ELSE p_size / 1000 END AS DECIMAL(18,8)) AS DECIMAL(18,6)) AS dividend_yield,
         CAST(CAST(CASE WHEN p_partkey % 5 < 2 THEN NULL ELSE p_retailprice / 100 END AS DECIMAL(18,8)) AS DECIMAL(18,4)) AS dividend_per_share,
         CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(round(p_retailprice * 1000) AS BIGINT) END AS revenue,
         CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(round(p_retailprice * 100) AS BIGINT) END AS net_profit,
         CAST(CAST(p_size / 2 AS DECIMAL(18,8)) AS DECIMAL(18,4)) AS roe,
         CAST(CAST(p_size / 25 AS DECIMAL(18,8)) AS DECIMAL(18,4)) AS debt_to_equity,
         CAST(CAST(p_retailprice / 2 AS DECIMAL(18,8)) AS DECIMAL(18,4)) AS book_value,
         CAST(1000 * p_size AS BIGINT) AS shares_outstanding
  FROM part
)"""

# Silver layer (M1–M3). A struct that begins with the fetch order is compared field by field, so its maximum within a
# key is the latest fetch; the previous quote is found by an ASOF join. Returns run on the unrounded converted close.
SILVER_PRICES = f"""
dedup_prices AS (
  SELECT ticker, trade_date, last.open_price, last.high_price, last.low_price, last.close_price, last.volume, last.currency,
         CASE last.currency WHEN 'GBp' THEN 0.01 ELSE 1.00 END AS unit
  FROM (SELECT ticker, trade_date,
               max({{'seq': fetch_seq, 'line': l_linenumber, 'part': l_partkey, 'supp': l_suppkey, 'open_price': open_price,
                    'high_price': high_price, 'low_price': low_price, 'close_price': close_price, 'volume': volume,
                    'currency': currency}}) AS last
        FROM bronze_prices GROUP BY ticker, trade_date)
),
silver_prices AS (
  SELECT now.ticker, now.trade_date,
         CAST(now.open_price * now.unit AS DECIMAL(18,4)) AS open_price,
         CAST(now.high_price * now.unit AS DECIMAL(18,4)) AS high_price,
         CAST(now.low_price * now.unit AS DECIMAL(18,4)) AS low_price,
         CAST(now.close_price * now.unit AS DECIMAL(18,4)) AS close_price,
         now.volume,
         {pct("now.close_price * now.unit", "before.close_price * before.unit", 10)} AS daily_return_pct,
         TRUE AS is_valid
  FROM dedup_prices now ASOF LEFT JOIN dedup_prices before
    ON now.ticker = before.ticker AND now.trade_date > before.trade_date
)"""

SILVER_FOREX = f"""
fx_days AS (
  SELECT currency_pair, trade_date, max({{'seq': fetch_seq, 'rate': close_rate}}).rate AS close_rate
  FROM bronze_forex GROUP BY currency_pair, trade_date
),
silver_forex AS (
  SELECT now.currency_pair, now.trade_date, now.close_rate,
         {pct("now.close_rate", "before.close_rate", 6, 6)} AS daily_change_pct,
         TRUE AS is_valid
  FROM fx_days now ASOF LEFT JOIN fx_days before
    ON now.currency_pair = before.currency_pair AND now.trade_date > before.trade_date
)"""

_FUND_COLUMNS = ("report_date", "market_cap", "pe_ratio", "pb_ratio", "dividend_yield", "dividend_per_share", "revenue", "net_profit", "roe",
                 "debt_to_equity", "book_value", "shares_outstanding")
SILVER_FUND = f"""
silver_fund AS (
  SELECT ticker, {", ".join("last." + c for c in _FUND_COLUMNS)}, TRUE AS is_valid
  FROM (SELECT ticker, max({{'seq': fetch_seq, {", ".join(f"'{c}': {c}" for c in _FUND_COLUMNS)}}}) AS last
        FROM bronze_fund GROUP BY ticker)
)"""

AS_OF = """
as_of AS (SELECT MAX(trade_date) AS d FROM silver_prices)"""

BASE_CTES = {
    "bronze_prices": BRONZE_PRICES,
    "companies": COMPANIES,
    "currency_map": CURRENCY_MAP,
    "bronze_forex": BRONZE_FOREX,
    "bronze_fund": BRONZE_FUND,
    "silver_prices": SILVER_PRICES,
    "silver_forex": SILVER_FOREX,
    "silver_fund": SILVER_FUND,
    "as_of": AS_OF,
}

# CTE dependencies (a CTE text may define several names).
_DEPS = {
    "silver_prices": ["bronze_prices"],
    "silver_forex": ["bronze_forex"],
    "silver_fund": ["bronze_fund"],
    "as_of": ["silver_prices"],
}


def with_ctes(names: list[str], extra: list[str] | None = None) -> str:
    """A WITH clause holding the named base CTEs (plus dependencies) and extra CTE texts."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [BASE_CTES[n].strip() for n in order] + [e.strip() for e in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n"
