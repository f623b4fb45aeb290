"""Query catalog: registered queries (Spark) and their DuckDB oracle SQL.

Every query reads the generated test tables through the proxy bronze layer, so
its work grows with the tables. Query keys follow the build plan's coverage
map; the operator IDs each one exercises are listed in README.md.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantleaf import schemas

from quantleaf.config import EngineConfig
from quantleaf.operators import gold as G
from quantleaf.operators import measures as M
from quantleaf.operators import quality as Q
from quantleaf.operators import period_states as PS
from quantleaf.operators import silver as S
from quantleaf.operators import trading_days as TD
from quantleaf.operators.asof import asof_join
from quantleaf.operators.cross_rates import cross_rates
from quantleaf.operators.windows import latest_by_key
from quantleaf.plans import pair_store
from quantleaf.plans import refresh as P
from quantleaf.plans import versions
from quantleaf.session import checkpointed
from quantleaf.plans.oracle import BASE_CTES, avg_dec, pct, quotient, whole, with_ctes
from quantleaf.sources import ingest as I
from quantleaf.sources import proxy

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLE[name] = oracle
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


# ----------------------------------------------------------------------------- layers

@dataclass
class Layers:
    bronze: proxy.Bronze
    silver: P.StoredSilver
    settings: EngineConfig

    @property
    def cfg(self) -> EngineConfig:
        """The settings with the reporting date (which the prices give, where it is not set)."""
        return self.settings.with_as_of(self.silver.as_of)

    def gold(self) -> P.GoldInputs:
        return P.gold_inputs(self.silver, self.cfg)


# Folder for materialised silver builds; None → the session's shared checkpoint folder.
silver_root: str | None = None


def layers(spark: SparkSession, sf_dir: str, cfg: EngineConfig | None = None) -> Layers:
    """Bronze (lazy, over the test tables) and silver (each table materialised on first use, once per input
    fingerprint, in the shared checkpoint folder, then read back)."""
    from quantleaf.session import checkpoint_dir
    cfg = cfg or EngineConfig()
    b = proxy.load(spark, sf_dir)
    inputs = [f"{sf_dir}/{t}.parquet" for t in ("lineitem", "part", "orders", "region")]
    return Layers(b, P.StoredSilver(spark, b, cfg, silver_root or checkpoint_dir(spark), inputs), cfg)


def _shared(g: P.GoldInputs) -> P.GoldInputs:
    """Gold inputs whose per-ticker and per-pair figures (one row each) are stored once, as the refresh does: the price
    history is then scanned once, however many steps use them."""
    g.stats, g.fx = checkpointed(g.stats), checkpointed(g.fx)
    return g


# ----------------------------------------------------------------------------- oracle pieces

# One grouped pass per ticker: picks by arg_max / arg_min, windows by FILTER (both variants' windows at once).
_STATS_SQL = f"""
known AS (SELECT p.*, d AS as_of_date, CAST(d - INTERVAL 12 MONTH AS DATE) AS cut, CAST(daily_return_pct AS DOUBLE) AS ret
          FROM silver_prices p CROSS JOIN as_of WHERE trade_date <= d),
picks AS (
  SELECT ticker, arg_max(close_price, trade_date) AS current_price, arg_max(volume, trade_date) AS latest_volume,
         arg_max(close_price, trade_date) FILTER (trade_date <= cut) AS year_ago_price,
         arg_min(close_price, trade_date) AS earliest_price, min(trade_date) AS earliest_date,
         max(high_price) FILTER (trade_date > as_of_date - 365) AS week_52_high,
         min(low_price) FILTER (trade_date > as_of_date - 365) AS week_52_low,
         CAST(stddev_samp(ret) FILTER (trade_date > as_of_date - 365) AS DECIMAL(18,4)) AS volatility,
         max(high_price) FILTER (trade_date > cut) AS year_high, min(low_price) FILTER (trade_date > cut) AS year_low,
         stddev_samp(ret) FILTER (trade_date > cut) AS year_deviation, count(*) FILTER (trade_date > cut) AS year_rows
  FROM known GROUP BY ticker),
stats AS (
  SELECT companies.ticker, picks.* EXCLUDE (ticker), coalesce(year_ago_price, earliest_price) AS base_price,
         {pct("current_price", "coalesce(year_ago_price, earliest_price)", 4)} AS yoy_raw
  FROM companies LEFT JOIN picks USING (ticker))"""

_PERF_SQL = f"""
perf AS (
  SELECT ticker, company_name, category, region, currency, CAST(current_price AS DECIMAL(18,4)) AS current_price,
         CAST(yoy_raw AS DECIMAL(18,4)) AS yoy_return_pct, CAST(week_52_high AS DECIMAL(18,4)) AS week_52_high,
         CAST(week_52_low AS DECIMAL(18,4)) AS week_52_low, volatility,
         {quotient(f"(({whole('current_price', 4)} - {whole('base_price', 4)}) * 10000000000)",
                   f"({whole('base_price', 4)} * {whole('volatility', 4)})")} AS sharpe_ratio,
         pe_ratio, market_cap, roe, debt_to_equity, dividend_yield
  FROM companies LEFT JOIN stats USING (ticker) LEFT JOIN silver_fund USING (ticker))"""

_FXS_SQL = """
pair_rates AS (
  SELECT currency_pair AS forex_pair, arg_max(close_rate, trade_date) AS end_rate,
         arg_max(close_rate, trade_date) FILTER (trade_date <= CAST(d - INTERVAL 12 MONTH AS DATE)) AS start_rate
  FROM silver_forex CROSS JOIN as_of WHERE trade_date <= d GROUP BY currency_pair)"""

def _currency_effect(home: str) -> str:
    """Home-currency return and its currency part from the local return and the first and last rate."""
    grown = f"((1000000 + {whole('local', 4)}) * {whole('last_rate', 6)} - 1000000 * {whole('first_rate', 6)})"
    return f"""CASE WHEN {home} THEN local ELSE {quotient(grown, whole('first_rate', 6))} END AS return_inr_pct,
         CASE WHEN {home} THEN 0 ELSE {quotient(f"({grown} - {whole('local', 4)} * {whole('first_rate', 6)})", whole('first_rate', 6))}
           END AS currency_impact_pct"""


_CUR_SQL = f"""
cur AS (
  SELECT ticker, company_name, category, region, currency AS original_currency, local AS return_local_pct,
         first_rate AS inr_start_rate, last_rate AS inr_end_rate, {_currency_effect("forex_pair IS NULL")}
  FROM (SELECT *
        FROM (SELECT companies.*, forex_pair, CAST(yoy_raw AS DECIMAL(18,4)) AS local,
                     CAST(CASE WHEN forex_pair IS NULL THEN 1 ELSE start_rate END AS DECIMAL(18,6)) AS first_rate,
                     CAST(CASE WHEN forex_pair IS NULL THEN 1 ELSE end_rate END AS DECIMAL(18,6)) AS last_rate
              FROM companies LEFT JOIN currency_map ON currency = currency_code
              LEFT JOIN stats USING (ticker) LEFT JOIN pair_rates USING (forex_pair))))"""

def _daily_sql(rate: str, fx_join: str, pair: str = "forex_pair", name: str = "daily") -> str:
    """Daily home-currency returns: ``rate`` is the rate of a row, ``fx_join`` how it meets the quotes; the row before is
    found by an ASOF join."""
    return f"""
valued AS (
  SELECT q.ticker, q.trade_date, q.close_price, q.daily_return_pct, {pair} AS pair, {rate} AS rate,
         CAST(q.close_price AS DECIMAL(28,4)) * {rate} AS home_value
  FROM (SELECT silver_prices.*, forex_pair
        FROM companies JOIN currency_map ON currency = currency_code JOIN silver_prices USING (ticker)) q
  {fx_join}),
{name} AS (
  SELECT t.ticker, t.trade_date, CAST(t.close_price AS DECIMAL(10,2)) AS close_price,
         CAST(t.home_value AS DECIMAL(10,2)) AS close_price_inr, CAST(t.daily_return_pct AS DECIMAL(10,2)) AS daily_return_local_pct,
         {pct("t.home_value", "y.home_value", 10, 2, 10)} AS daily_return_inr_pct,
         CAST(t.rate AS DECIMAL(10,2)) AS forex_rate, t.pair AS currency_pair
  FROM valued t ASOF LEFT JOIN valued y ON t.ticker = y.ticker AND t.trade_date > y.trade_date)"""


_ONE = "CAST(1 AS DECIMAL(18,6))"
_SAME_DAY = "LEFT JOIN silver_forex fx ON q.forex_pair = fx.currency_pair AND q.trade_date = fx.trade_date"
_LAST_KNOWN = "ASOF LEFT JOIN silver_forex fx ON q.forex_pair = fx.currency_pair AND q.trade_date >= fx.trade_date"
# Rate 1 for the home currency only; no quote yet: NULL.
_HOME_ONE = f"CASE WHEN q.forex_pair IS NULL THEN {_ONE} ELSE fx.close_rate END"
_DAILY_SQL = _daily_sql(f"coalesce(fx.close_rate, {_ONE})", _SAME_DAY)

_GOLD_BASE = ["bronze_prices", "companies", "currency_map", "bronze_forex", "bronze_fund",
              "silver_prices", "silver_forex", "silver_fund", "as_of"]


def _oracle(names: list[str], extra: list[str], tail: str) -> str:
    return with_ctes(names, extra) + tail


# ----------------------------------------------------------------------------- silver

@register("silver_prices", _oracle(["silver_prices"], [], "SELECT * FROM silver_prices"))
def q_silver_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built from bronze, not read from a stored build."""
    b, cfg = proxy.load(spark, sf_dir), EngineConfig()
    return S.clean_prices(b.prices, b.price_order, cfg.minor_units, cfg.bucket_days, True, cfg.minor_units_by_ticker)


@register("silver_forex", _oracle(["silver_forex"], [], "SELECT * FROM silver_forex"))
def q_silver_forex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: built from bronze."""
    b = proxy.load(spark, sf_dir)
    return S.clean_forex(b.forex, b.fx_order, EngineConfig().bucket_days, True)


@register("silver_fundamentals", _oracle(["silver_fund"], [], "SELECT * FROM silver_fund"))
def q_silver_fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: built from bronze."""
    b = proxy.load(spark, sf_dir)
    return S.clean_fundamentals(b.fundamentals, b.fund_order)


_CAL_SQL = """
SELECT date_key,
       CAST(dayofweek(date_key) + 1 AS INTEGER) AS day_of_week,
       dayname(date_key) AS day_name,
       CAST(floor((dayofyear(date_key) + dayofweek(date_trunc('year', date_key)) + 1 - 2) / 7) + 1 AS INTEGER) AS week_number,
       CAST(month(date_key) AS INTEGER) AS month_number,
       monthname(date_key) AS month_name,
       CAST(quarter(date_key) AS INTEGER) AS quarter,
       'Q' || CAST(quarter(date_key) AS VARCHAR) AS quarter_name,
       CAST(year(date_key) AS INTEGER) AS year,
       dayofweek(date_key) IN (0, 6) AS is_weekend,
       dayofweek(date_key) NOT IN (0, 6) AS is_trading_day
FROM (SELECT CAST(unnest(generate_series(MIN(trade_date), MAX(trade_date), INTERVAL 1 DAY)) AS DATE) AS date_key
      FROM bronze_prices) d"""


@register("calendar_dim", _oracle(["bronze_prices"], [], _CAL_SQL))
def q_calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 over the span of the price history."""
    return S.calendar_for(proxy.bronze_prices(spark, sf_dir))


# ----------------------------------------------------------------------------- gold

_YOY_TAIL = """
SELECT c.ticker, CAST(s.current_price AS DECIMAL(18,4)) AS current_price,
       s.year_ago_price, s.earliest_price, CAST(s.yoy_raw AS DECIMAL(18,4)) AS yoy_return_pct
FROM companies c LEFT JOIN stats s ON c.ticker = s.ticker"""


@register("gold_yoy_return", _oracle(_GOLD_BASE, [_STATS_SQL], _YOY_TAIL))
def q_gold_yoy_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum slice: M1 → current price and YoY return with the earliest-price fallback."""
    g = layers(spark, sf_dir).gold()
    s = g.stats
    return (g.silver.companies.select("ticker").join(s, "ticker", "left")
            .select("ticker", G.X.to_dec("current_price").alias("current_price"),
                    "year_ago_price", "earliest_price",
                    G.X.to_dec("yoy_raw").alias("yoy_return_pct")))


@register("gold_stock_performance", _oracle(_GOLD_BASE, [_STATS_SQL, _PERF_SQL], "SELECT * FROM perf"))
def q_gold_stock_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6."""
    return P.stock_performance(layers(spark, sf_dir).gold())


_AVERAGES = f"""{avg_dec('yoy_return_pct', 4, 'average_yoy_return_pct')}, {avg_dec('volatility', 4, 'avg_volatility')}"""
_TOTALS = f"""{avg_dec('pe_ratio', 4, 'avg_pe_ratio')}, CAST(SUM(market_cap) AS BIGINT) AS total_market_cap,
       {avg_dec('dividend_yield', 6, 'avg_dividend_yield')}"""
# Best and worst: the smallest struct of (key, ticker), so equal returns go to the first ticker.
_BEST = "struct_extract(min({'k': -yoy_return_pct, 't': ticker}) FILTER (yoy_return_pct IS NOT NULL), 't')"
_WORST = "struct_extract(min({'k': yoy_return_pct, 't': ticker}) FILTER (yoy_return_pct IS NOT NULL), 't')"
_CAT_TAIL = f"""
SELECT category, {_AVERAGES}, {_BEST} AS best_stock, {_WORST} AS worst_stock, {_TOTALS}
FROM perf GROUP BY category"""


@register("gold_category_performance", _oracle(_GOLD_BASE, [_STATS_SQL, _PERF_SQL], _CAT_TAIL))
def q_gold_category_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8."""
    return G.category_performance(P.stock_performance(layers(spark, sf_dir).gold()))


@register("gold_currency_adjusted_returns",
          _oracle(_GOLD_BASE, [_STATS_SQL, _FXS_SQL, _CUR_SQL], "SELECT * FROM cur"))
def q_gold_currency_adjusted_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7."""
    return P.currency_adjusted(layers(spark, sf_dir).gold())


_FIRST_CATEGORY = "struct_extract(min({'k': -%s, 'c': category}) FILTER (%s IS NOT NULL), 'c')"
_REGION_TAIL = f"""
, by_category AS (SELECT region, category, AVG(yoy_return_pct) AS mean FROM perf GROUP BY ALL),
leaders AS (SELECT region, {_FIRST_CATEGORY % ("mean", "mean")} AS best_category FROM by_category GROUP BY region),
impacts AS (SELECT region, {avg_dec('currency_impact_pct', 4, 'impact')} FROM cur GROUP BY region),
figures AS (SELECT region, {avg_dec('yoy_return_pct', 4, 'avg_yoy_return_pct')}, {avg_dec('volatility', 4, 'avg_volatility')},
                   {avg_dec('sharpe_ratio', 4, 'avg_sharpe_ratio')}, CAST(COUNT(*) AS INTEGER) AS stock_count FROM perf GROUP BY region)
SELECT figures.*, best_category, coalesce(impact, CAST(0 AS DECIMAL(18,4))) AS avg_currency_impact_pct
FROM figures LEFT JOIN leaders USING (region) LEFT JOIN impacts USING (region)"""


# The region oracle appends its own CTEs after the shared ones.
@register("gold_region_performance",
          with_ctes(_GOLD_BASE, [_STATS_SQL, _PERF_SQL, _FXS_SQL, _CUR_SQL]).rstrip() + _REGION_TAIL)
def q_gold_region_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9."""
    g = _shared(layers(spark, sf_dir).gold())
    return G.region_performance(P.stock_performance(g), P.currency_adjusted(g))

_DIV_TAIL = """
SELECT ticker, company_name, category, region, CAST(current_price AS DECIMAL(18,4)) AS stock_price,
       CAST(dividend_per_share AS DECIMAL(18,4)) AS annual_dividend, CAST(dividend_yield AS DECIMAL(18,6)) AS dividend_yield_pct,
       CAST(CAST(dividend_per_share AS DOUBLE)
            / NULLIF(CAST(net_profit AS DOUBLE) / CASE WHEN shares_outstanding > 0 THEN CAST(shares_outstanding AS DOUBLE) END, 0)
            AS DECIMAL(18,4)) AS payout_ratio,
       CAST(coalesce(dividend_per_share, 0) * coalesce(end_rate, CAST(1 AS DECIMAL(18,6))) AS DECIMAL(18,4)) AS dividend_in_inr,
       coalesce(dividend_yield > 0, FALSE) AS pays_dividend
FROM companies LEFT JOIN stats USING (ticker) LEFT JOIN silver_fund USING (ticker)
LEFT JOIN currency_map ON currency = currency_code LEFT JOIN pair_rates USING (forex_pair)"""


@register("gold_dividend_analysis", _oracle(_GOLD_BASE, [_STATS_SQL, _FXS_SQL], _DIV_TAIL))
def q_gold_dividend_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10."""
    return P.dividend(layers(spark, sf_dir).gold())


@register("gold_daily_inr_returns", _oracle(_GOLD_BASE, [_DAILY_SQL], "SELECT * FROM daily"))
def q_gold_daily_inr_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 (missing FX → rate 1)."""
    L = layers(spark, sf_dir)
    s = L.silver
    return G.daily_inr_returns(s.prices, s.forex, s.companies, s.currency_map, L.cfg)


# DuckDB's own corr() over the paired days, where both series vary.
_CORR_SQL = """
moves AS (SELECT ticker, trade_date, CAST(daily_return_pct AS DOUBLE) AS move FROM silver_prices WHERE daily_return_pct IS NOT NULL),
paired AS (
  SELECT a.ticker AS stock_1, b.ticker AS stock_2,
         CASE WHEN min(a.move) < max(a.move) AND min(b.move) < max(b.move) THEN corr(a.move, b.move) END AS r
  FROM moves a JOIN moves b ON a.trade_date = b.trade_date AND a.ticker < b.ticker GROUP BY ALL)"""


def _corr_tail(coefficient: str, null_label: str, join: str) -> str:
    return f"""
SELECT stock_1, stock_2, one.category AS stock_1_category, two.category AS stock_2_category, one.region AS stock_1_region,
       two.region AS stock_2_region, CAST(r AS DECIMAL(18,4)) AS correlation_coefficient,
       CASE WHEN {coefficient} IS NULL THEN {null_label} WHEN {coefficient} < -0.3 THEN 'Negative'
            WHEN {coefficient} < 0.3 THEN 'Uncorrelated' WHEN {coefficient} < 0.7 THEN 'Weak Positive' ELSE 'Strong Positive' END AS relationship
FROM paired {join} companies one ON stock_1 = one.ticker {join} companies two ON stock_2 = two.ticker"""


_CORR_TAIL = _corr_tail("CAST(r AS DECIMAL(18,4))", "NULL", "LEFT JOIN")


@register("gold_correlation_matrix", _oracle(["silver_prices", "companies"], [_CORR_SQL], _CORR_TAIL))
def q_gold_correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 via block-wise Gram sums."""
    L = layers(spark, sf_dir)
    return P.correlation(L.gold())


# ----------------------------------------------------------------------------- measures



def _daily(L: Layers) -> DataFrame:
    s = L.silver
    return G.daily_inr_returns(s.prices, s.forex, s.companies, s.currency_map, L.cfg)


_PR_SQL = f"""
pr AS (
  SELECT period, ticker, first_close, last_close,
         {pct("last_close", "first_close", 4)} AS local_return_pct,
         {pct("last_inr", "first_inr", 4)} AS inr_return_pct
  FROM (SELECT CAST(year(trade_date) AS INTEGER) AS period, ticker,
               arg_min(close_price, trade_date) AS first_close, arg_max(close_price, trade_date) AS last_close,
               arg_min(close_price_inr, trade_date) AS first_inr, arg_max(close_price_inr, trade_date) AS last_inr
        FROM daily GROUP BY ALL))"""


@register("period_returns", _oracle(_GOLD_BASE, [_DAILY_SQL, _PR_SQL], """
SELECT period, ticker, first_close, last_close, local_return_pct, inr_return_pct,
       CAST(inr_return_pct - local_return_pct AS DECIMAL(18,4)) AS currency_impact_pct
FROM pr"""))
def q_period_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15–M17 per (year, ticker)."""
    return M.period_returns(_daily(layers(spark, sf_dir)))


@register("category_period_returns", _oracle(_GOLD_BASE, [_DAILY_SQL, _PR_SQL], f"""
SELECT pr.period, c.category, {avg_dec('pr.local_return_pct', 4, 'avg_local_return_pct')},
       {avg_dec('pr.inr_return_pct', 4, 'avg_inr_return_pct')}, COUNT(*) AS ticker_count
FROM pr JOIN companies c ON pr.ticker = c.ticker GROUP BY pr.period, c.category"""))
def q_category_period_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M18 (G9, G14, J13)."""
    L = layers(spark, sf_dir)
    return M.category_period_returns(_daily(L), L.silver.companies)


@register("category_period_volatility", _oracle(_GOLD_BASE, [_DAILY_SQL], f"""
SELECT v.period, c.category, {avg_dec('v.volatility', 4, 'avg_volatility')}, COUNT(v.volatility) AS ticker_count
FROM (SELECT CAST(year(trade_date) AS INTEGER) AS period, ticker,
             CAST(STDDEV_POP(CAST(daily_return_local_pct AS DOUBLE)) AS DECIMAL(18,4)) AS volatility
      FROM daily GROUP BY year(trade_date), ticker) v
JOIN companies c ON v.ticker = c.ticker GROUP BY v.period, c.category"""))
def q_category_period_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M19 (G6, G9)."""
    L = layers(spark, sf_dir)
    return M.category_period_volatility(_daily(L), L.silver.companies)


@register("best_worst_stock", _oracle(_GOLD_BASE, [_DAILY_SQL, _PR_SQL], """
, pr2 AS (SELECT pr.period, c.category, pr.ticker, pr.local_return_pct AS return_pct
          FROM pr JOIN companies c ON pr.ticker = c.ticker WHERE pr.local_return_pct IS NOT NULL)
SELECT period, category, kind, ticker, return_pct FROM (
  SELECT period, category, 'best' AS kind, ticker, return_pct,
         RANK() OVER (PARTITION BY period, category ORDER BY return_pct DESC) AS r FROM pr2
  UNION ALL
  SELECT period, category, 'worst' AS kind, ticker, return_pct,
         RANK() OVER (PARTITION BY period, category ORDER BY return_pct ASC) AS r FROM pr2) x
WHERE r = 1"""))
def q_best_worst_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M20 (W10, T4): TOPN(1) with ties per (year, category)."""
    L = layers(spark, sf_dir)
    return M.best_worst_stock(_daily(L), L.silver.companies)


@register("dynamic_dividend_yield", _oracle(_GOLD_BASE, [_DAILY_SQL], """
SELECT l.period, l.ticker, l.last_close, f.dividend_per_share,
       CAST(CAST(f.dividend_per_share AS DOUBLE) / NULLIF(CAST(l.last_close AS DOUBLE), 0) * 100 AS DECIMAL(18,6))
         AS dividend_yield_pct
FROM (SELECT CAST(year(trade_date) AS INTEGER) AS period, ticker, arg_max(close_price, trade_date) AS last_close
      FROM daily GROUP BY ALL) l
JOIN silver_fund f ON l.ticker = f.ticker"""))
def q_dynamic_dividend_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M21."""
    L = layers(spark, sf_dir)
    return M.dynamic_dividend_yield(_daily(L), L.silver.fundamentals)


_SCEN_TAIL = """
, g AS (
  SELECT cur.ticker, CAST(cur.return_inr_pct AS DECIMAL(18,4)) AS return_pct, a.amount, t.tax_rate,
         CAST(a.amount AS DECIMAL(38,2)) * CAST(cur.return_inr_pct AS DECIMAL(38,4)) * CAST(0.01 AS DECIMAL(2,2)) AS gross
  FROM cur,
       (SELECT CAST(v AS DECIMAL(12,2)) AS amount FROM (VALUES (10000), (50000), (100000), (500000)) t(v)) a,
       (SELECT CAST(v AS DECIMAL(5,4)) AS tax_rate FROM (VALUES ('0'), ('0.1'), ('0.15'), ('0.2'), ('0.3')) t(v)) t
  WHERE cur.return_inr_pct IS NOT NULL)
SELECT ticker, return_pct, amount, tax_rate,
       CAST(gross AS DECIMAL(18,2)) AS gross_gain,
       CAST(GREATEST(gross, 0) * tax_rate AS DECIMAL(18,2)) AS tax,
       CAST(gross - GREATEST(gross, 0) * tax_rate AS DECIMAL(18,2)) AS net_gain,
       CAST(amount + gross - GREATEST(gross, 0) * tax_rate AS DECIMAL(18,2)) AS final_value
FROM g"""


@register("scenario_returns",
          with_ctes(_GOLD_BASE, [_STATS_SQL, _FXS_SQL, _CUR_SQL]).rstrip() + _SCEN_TAIL)
def q_scenario_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M22 what-if grid over the home-currency returns (generator, no join)."""
    return M.scenario_returns(P.currency_adjusted(layers(spark, sf_dir).gold()))


@register("week52_position", _oracle(_GOLD_BASE, [_STATS_SQL, _PERF_SQL], """
SELECT ticker, current_price, week_52_low, week_52_high,
       CAST(CAST(current_price - week_52_low AS DOUBLE) / NULLIF(CAST(week_52_high - week_52_low AS DOUBLE), 0) * 100
            AS DECIMAL(18,4)) AS position_pct
FROM perf"""))
def q_week52_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M23."""
    return M.week52_position(P.stock_performance(layers(spark, sf_dir).gold()))


def _rank_sql(value: str, partition: str | None, desc: bool = True) -> str:
    part = f"{partition}, " if partition else ""
    order = "DESC" if desc else "ASC"
    return (f"CASE WHEN {value} IS NULL THEN NULL ELSE CAST(RANK() OVER "
            f"(PARTITION BY {part}({value} IS NULL) ORDER BY {value} {order}) AS INTEGER) END")


@register("yoy_comparison", _oracle(_GOLD_BASE, [_STATS_SQL, _PERF_SQL], f"""
SELECT category, ticker, yoy_return_pct, {_rank_sql('yoy_return_pct', 'category')} AS category_rank FROM perf"""))
def q_yoy_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M24 (W10)."""
    return M.yoy_comparison(checkpointed(P.stock_performance(layers(spark, sf_dir).gold())))


_DIV_CTE = """
div AS (""" + _DIV_TAIL + ")"


@register("dividend_ranking", _oracle(_GOLD_BASE, [_STATS_SQL, _FXS_SQL, _DIV_CTE], f"""
SELECT ticker, company_name, dividend_yield_pct, annual_dividend, pays_dividend,
       {_rank_sql('dividend_yield_pct', None)} AS yield_rank FROM div"""))
def q_dividend_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M27 (T2, W10)."""
    return M.dividend_ranking(checkpointed(P.dividend(layers(spark, sf_dir).gold())))


@register("sharpe_ranking", _oracle(_GOLD_BASE, [_STATS_SQL, _PERF_SQL], f"""
, sh AS (SELECT ticker, yoy_return_pct, volatility,
                CAST(CASE WHEN volatility IS NULL OR volatility = 0 THEN NULL
                          ELSE (CAST(yoy_return_pct AS DOUBLE) - 0.0) / CAST(volatility AS DOUBLE) END AS DECIMAL(18,4)) AS sharpe
         FROM perf)
SELECT ticker, yoy_return_pct, volatility, sharpe, {_rank_sql('sharpe', None)} AS sharpe_rank FROM sh"""))
def q_sharpe_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M28 (rf = 0 as the reference)."""
    return M.sharpe_ranking(checkpointed(P.stock_performance(layers(spark, sf_dir).gold())))


@register("price_volume_series", _oracle(["silver_prices"], [], """
SELECT ticker, trade_date, close_price, volume FROM silver_prices ORDER BY ticker, trade_date"""))
def q_price_volume_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M25 over every ticker and the whole history."""
    return M.price_volume_series(layers(spark, sf_dir).silver.prices)


@register("forex_trend", _oracle(["silver_forex"], [], """
SELECT currency_pair, trade_date, close_rate, daily_change_pct FROM silver_forex ORDER BY currency_pair, trade_date"""))
def q_forex_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M26 over every pair."""
    return M.forex_trend(layers(spark, sf_dir).silver.forex)


@register("top5_latest", _oracle(["silver_prices"], [], """
SELECT * FROM silver_prices ORDER BY trade_date DESC, ticker LIMIT 5"""))
def q_top5_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOP 5 … ORDER BY trade_date DESC (the limit is the feature)."""
    return M.top_latest(layers(spark, sf_dir).silver.prices, 5)


@register("single_stock_metrics", _oracle(_GOLD_BASE, [_STATS_SQL], """
SELECT c.ticker, c.company_name, c.category, c.region, c.currency,
       CAST(s.current_price AS DECIMAL(18,4)) AS current_price,
       CAST(s.week_52_high AS DECIMAL(18,4)) AS week_52_high,
       CAST(s.week_52_low AS DECIMAL(18,4)) AS week_52_low,
       CAST(s.yoy_raw AS DECIMAL(18,4)) AS yoy_return_pct,
       s.latest_volume, f.market_cap, f.pe_ratio, f.pb_ratio, f.roe, f.debt_to_equity, f.book_value,
       f.revenue, f.net_profit, f.dividend_per_share, f.dividend_yield, s.volatility
FROM companies c LEFT JOIN stats s ON c.ticker = s.ticker LEFT JOIN silver_fund f ON c.ticker = f.ticker"""))
def q_single_stock_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M32."""
    g = layers(spark, sf_dir).gold()
    return M.single_stock_metrics(g.stats, g.silver.companies, g.silver.fundamentals)


# ----------------------------------------------------------------------------- planned cleaning steps

_FFILL_SQL = """
SELECT d.currency_pair, d.trade_date,
       LAST_VALUE(f.close_rate IGNORE NULLS) OVER (PARTITION BY d.currency_pair ORDER BY d.trade_date
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close_rate,
       (f.close_rate IS NOT NULL) AS is_valid
FROM (SELECT currency_pair,
             CAST(unnest(generate_series(MIN(trade_date), MAX(trade_date), INTERVAL 1 DAY)) AS DATE) AS trade_date
      FROM silver_forex GROUP BY currency_pair) d
LEFT JOIN silver_forex f ON d.currency_pair = f.currency_pair AND d.trade_date = f.trade_date"""


@register("forward_fill", _oracle(["silver_forex"], [], _FFILL_SQL))
def q_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX on every calendar day of each pair's span, gaps filled, is_valid = false when imputed."""
    fx = layers(spark, sf_dir).silver.forex.select("currency_pair", "trade_date", "close_rate",
                                                    F.lit(True).alias("is_valid"))
    spans = fx.groupBy("currency_pair").agg(F.min("trade_date").alias("_s"), F.max("trade_date").alias("_e"))
    days = spans.select("currency_pair", F.explode(F.sequence("_s", "_e")).alias("trade_date"))
    dense = (days.join(fx, ["currency_pair", "trade_date"], "left")
             .withColumn("is_valid", F.coalesce("is_valid", F.lit(True))))
    return S.forward_fill(dense, ["currency_pair"], "trade_date", ["close_rate"], 90, "is_valid")


@register("normalize_pairs", _oracle(["silver_forex"], [], """
SELECT CASE WHEN split_part(currency_pair, '/', 1) = 'INR'
            THEN split_part(currency_pair, '/', 2) || '/' || split_part(currency_pair, '/', 1)
            ELSE currency_pair END AS currency_pair,
       trade_date,
       CAST(CASE WHEN split_part(currency_pair, '/', 1) = 'INR'
                 THEN 1.0 / NULLIF(CAST(close_rate AS DOUBLE), 0) ELSE CAST(close_rate AS DOUBLE) END AS DECIMAL(18,6))
         AS close_rate,
       split_part(currency_pair, '/', 1) = 'INR' AS was_inverted
FROM silver_forex"""))
def q_normalize_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair as X/INR."""
    return S.normalize_pairs(layers(spark, sf_dir).silver.forex, "INR")


@register("standardize_quarter", _oracle(["silver_prices"], [], """
SELECT ticker, CAST(last_day(date_trunc('quarter', trade_date) + INTERVAL 2 MONTH) AS DATE) AS quarter_end_date,
       arg_max(close_price, trade_date) AS quarter_close, COUNT(*) AS n_days
FROM silver_prices GROUP BY ALL"""))
def q_standardize_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade dates mapped to their quarter end; last close and day count per (ticker, quarter)."""
    p = S.standardize_quarter(layers(spark, sf_dir).silver.prices, "trade_date", "quarter_end_date")
    d = F.col("trade_date")
    return (p.groupBy("ticker", "quarter_end_date")
            .agg(F.max_by("close_price", d).alias("quarter_close"), F.count(F.lit(1)).alias("n_days")))


_ASOF_SQL = _daily_sql(_HOME_ONE, _LAST_KNOWN, name="daily_asof")


@register("daily_returns_asof_fx", _oracle(_GOLD_BASE, [_ASOF_SQL], "SELECT * FROM daily_asof"))
def q_daily_returns_asof_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J14 + W9: M12 with the last known FX rate on days without a quote; NULL before a pair's first quote."""
    return _daily_with(layers(spark, sf_dir), "asof")


@register("daily_returns_asof_fx_early", _oracle(_GOLD_BASE, [_ASOF_SQL], "SELECT * FROM daily_asof"))
def q_daily_returns_asof_fx_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J14 with a reporting date in the middle of the history: prices after it still meet their own rates."""
    import datetime as dt
    return _daily_with(layers(spark, sf_dir, EngineConfig(as_of=dt.date(1999, 6, 30))), "asof")


@register("daily_returns_null_fx", _oracle(_GOLD_BASE, [_daily_sql(_HOME_ONE, _SAME_DAY)], "SELECT * FROM daily"))
def q_daily_returns_null_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 with NULL home-currency values on days without a quote."""
    return _daily_with(layers(spark, sf_dir), "null")


_STALE_DAYS = 2


@register("asof_rates_with_tolerance", _oracle(["silver_prices", "silver_forex", "companies", "currency_map"], [], f"""
SELECT q.ticker, q.trade_date, q.forex_pair,
       CASE WHEN q.trade_date - fx.trade_date <= {_STALE_DAYS} THEN fx.close_rate END AS close_rate,
       CASE WHEN q.trade_date - fx.trade_date <= {_STALE_DAYS} THEN fx.trade_date END AS quote_date
FROM (SELECT ticker, trade_date, forex_pair FROM silver_prices JOIN companies USING (ticker) JOIN currency_map ON currency = currency_code) q
ASOF LEFT JOIN silver_forex fx ON q.forex_pair = fx.currency_pair AND q.trade_date >= fx.trade_date"""))
def q_asof_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last quote of a row's pair at or before its day, not older than a few days, and its date."""
    s = layers(spark, sf_dir).silver
    pairs = G.ticker_pairs(s.companies, s.currency_map).join(s.currency_map.select("currency_code"), F.col("currency") == F.col("currency_code"))
    rows = s.prices.select("ticker", "trade_date").join(pairs.select("ticker", "forex_pair"), "ticker")
    quotes = s.forex.select(F.col("currency_pair").alias("forex_pair"), "trade_date", "close_rate")
    return asof_join(rows, quotes, ["forex_pair"], "trade_date", ["close_rate"], tolerance_days=_STALE_DAYS, quote_date="quote_date", salts=4)


def _daily_with(L: Layers, fx_policy: str) -> DataFrame:
    from dataclasses import replace
    g = P.gold_inputs(L.silver, replace(L.cfg, fx_policy=fx_policy))
    return P.daily_inr(g)


# ----------------------------------------------------------------------------- ingestion


_EXCHANGE_OF_QUOTE = {"USD": "NYSE", "GBp": "LSE", "EUR": "XETRA", "INR": "NSE"}


def proxy_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor-shaped JSON payloads derived from the proxy bronze prices: one document per
    (ticker, fetch) holding that fetch's quotes (an order's lines: a bounded group)."""
    b = proxy.bronze_prices(spark, sf_dir)
    exch = F.create_map(*[F.lit(x) for kv in _EXCHANGE_OF_QUOTE.items() for x in kv])[F.col("currency")]
    quote = F.struct(F.date_format("trade_date", "yyyy-MM-dd").alias("datetime"),
                     F.col("open_price").cast("string").alias("open"),
                     F.col("high_price").cast("string").alias("high"),
                     F.col("low_price").cast("string").alias("low"),
                     F.col("close_price").cast("string").alias("close"),
                     F.col("volume").cast("string").alias("volume"))
    # collect_list gains nothing from a map-side partial aggregate (it keeps every
    # value), so hash-partition on the document key first: same shuffle volume, and
    # the grouping runs in the post-shuffle tasks.
    docs = (b.withColumn("exchange", exch)
            .repartition("ticker", "fetch_seq")
            .groupBy("ticker", "fetch_seq", "exchange", "currency")
            .agg(F.collect_list(quote).alias("values")))
    return docs.select(
        I.price_symbol(F.col("ticker")).alias("symbol"), I.price_exchange(F.col("exchange")).alias("exchange"), "currency",
        # wall-clock time of the fetch (epoch + seconds) as TIMESTAMP_NTZ: no session time zone
        F.date_format(F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, fetch_seq)"),
                      "yyyy-MM-dd HH:mm:ss").alias("fetched_at"),
        "values", "fetch_seq")


_PAYLOAD_SQL = """
SELECT ticker, trade_date, open_price, high_price, low_price, close_price, volume,
       CASE currency WHEN 'USD' THEN 'NYSE' WHEN 'GBp' THEN 'LSE' WHEN 'EUR' THEN 'XETRA' ELSE 'NSE' END AS exchange,
       currency, make_timestamp(fetch_seq * 1000000) AS api_fetched_at
FROM bronze_prices"""


@register("ingest_payload", _oracle(["bronze_prices"], [], _PAYLOAD_SQL))
def q_ingest_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON payload strings → bronze rows (vendor symbols mapped back to tickers)."""
    docs = proxy_payloads(spark, sf_dir).drop("fetch_seq").select(F.to_json(F.struct("*")).alias("value"))
    return I.parse_price_payloads(I.payloads_from_strings(docs))


def _epoch_text(seconds_col: str) -> Column:
    """Wall-clock fetch time (epoch + seconds) as text, independent of the session time zone."""
    return F.date_format(F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds_col})"),
                         "yyyy-MM-dd HH:mm:ss")


@register("ingest_forex_payload", _oracle(["bronze_forex"], [], """
SELECT currency_pair, trade_date, CAST(NULL AS DECIMAL(18,6)) AS open_rate, CAST(NULL AS DECIMAL(18,6)) AS high_rate,
       CAST(NULL AS DECIMAL(18,6)) AS low_rate, close_rate, make_timestamp(fetch_seq * 1000000) AS api_fetched_at
FROM bronze_forex"""))
def q_ingest_forex_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14 (forex): one JSON document per pair and fetch → bronze FX rows."""
    fx = proxy.bronze_forex(spark, sf_dir)
    quote = F.struct(F.date_format("trade_date", "yyyy-MM-dd").alias("datetime"),
                     F.col("close_rate").cast("string").alias("close"))
    docs = fx.select(F.col("currency_pair").alias("symbol"), _epoch_text("fetch_seq").alias("fetched_at"),
                     F.array(quote).alias("values"))
    return I.parse_forex_payloads(I.payloads_from_strings(docs.select(F.to_json(F.struct("*")).alias("value")),
                                                          schema=schemas.FOREX_PAYLOAD))


@register("ingest_fundamentals_payload", _oracle(["bronze_fund", "companies"], [], """
SELECT f.ticker, f.report_date, f.market_cap, f.pe_ratio, f.pb_ratio, f.dividend_yield, f.dividend_per_share,
       f.revenue, f.net_profit, f.roe, f.debt_to_equity, f.book_value, f.shares_outstanding,
       make_timestamp(f.fetch_seq * 1000000) AS api_fetched_at
FROM bronze_fund f JOIN companies c ON f.ticker = c.ticker"""))
def q_ingest_fundamentals_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14 (fundamentals): one JSON document per vendor symbol and fetch → bronze rows (S7 mapping)."""
    f = proxy.bronze_fundamentals(spark, sf_dir)
    exch = proxy.companies(spark, sf_dir).select("ticker", "exchange")
    docs = f.join(exch, "ticker", "inner").select(
        I.vendor_symbol(F.col("ticker"), F.col("exchange")).alias("symbol"),
        _epoch_text("fetch_seq").alias("fetched_at"),
        F.col("report_date").cast("string").alias("report_date"),
        *[F.col(c).cast("string").alias(c) for c in schemas.FUNDAMENTAL_COLUMNS])
    return I.parse_fundamental_payloads(I.payloads_from_strings(
        docs.select(F.to_json(F.struct("*")).alias("value")), schema=schemas.FUNDAMENTALS_PAYLOAD))


_SPLIT_SQL = """
, sp AS (SELECT (MIN(fetch_seq) + MAX(fetch_seq)) // 2 AS s FROM bronze_prices),
st AS (SELECT b.* FROM bronze_prices b, sp WHERE b.fetch_seq <= sp.s),
ar AS (SELECT b.* FROM bronze_prices b, sp WHERE b.fetch_seq > sp.s)"""


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Bronze rows split by fetch order into already-stored and newly arriving halves."""
    b = proxy.bronze_prices(spark, sf_dir)
    # The fetch order is a column of lineitem and every row has its part: its ends need no join.
    lo, hi = spark.read.parquet(f"{sf_dir}/lineitem.parquet").agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    s = (lo + hi) // 2
    return b.where(F.col("fetch_seq") <= s), b.where(F.col("fetch_seq") > s)


@register("ingest_incremental", with_ctes(["bronze_prices"]).rstrip() + _SPLIT_SQL + """
, latest AS (SELECT ticker, MAX(trade_date) AS l FROM st GROUP BY ticker)
SELECT ar.* FROM ar LEFT JOIN latest ON ar.ticker = latest.ticker
WHERE latest.l IS NULL OR ar.trade_date > latest.l""")
def q_ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append only rows dated after the latest stored date per ticker."""
    stored, arriving = _split(spark, sf_dir)
    return I.newer_than_stored(stored, arriving)


@register("ingest_anti", with_ctes(["bronze_prices"]).rstrip() + _SPLIT_SQL + """
SELECT ar.* FROM ar WHERE NOT EXISTS (
  SELECT 1 FROM st WHERE st.ticker = ar.ticker AND st.trade_date = ar.trade_date)""")
def q_ingest_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate check — append rows whose (ticker, trade_date) is not stored yet."""
    stored, arriving = _split(spark, sf_dir)
    return I.not_yet_stored(stored, arriving)


# Planted faults, by fetch: broken JSON, an error response, no values, an unreadable close, an unreadable date.
_FAULTS = 11


def _faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed documents (fetch_seq, value), some of them faulty."""
    m = F.pmod(F.col("fetch_seq"), F.lit(_FAULTS))
    docs = proxy_payloads(spark, sf_dir).withColumn("values", F.when(m == 3, F.array_compact(F.array(F.lit(None).cast(
        schemas.PRICE_PAYLOAD["values"].dataType.elementType)))).when(m == 4, F.transform("values", lambda v: v.withField("close", F.lit("n/a"))))
        .when(m == 5, F.transform("values", lambda v: v.withField("datetime", F.lit("yesterday")))).otherwise(F.col("values")))
    text = F.to_json(F.struct("symbol", "exchange", "currency", "fetched_at", "values"))
    return docs.select("fetch_seq", F.when(m == 1, F.substring(text, 1, 25)).when(m == 2, F.lit('{"code": 429, "message": "limit", "status": "error"}'))
                       .otherwise(text).alias("value"))


_REJECTS_SQL = f"""
, documents_of AS (SELECT ticker, fetch_seq, count(*) AS entries FROM bronze_prices GROUP BY ALL),
units AS (
  SELECT CASE WHEN fetch_seq % {_FAULTS} NOT IN (1, 2) THEN ticker END AS symbol,
         ['broken JSON', 'error response', 'no values', 'bad close', 'bad datetime'][fetch_seq % {_FAULTS}] AS reason,
         CASE WHEN fetch_seq % {_FAULTS} IN (1, 2, 3) THEN 1 ELSE entries END AS n
  FROM documents_of)
SELECT symbol, coalesce(reason, 'accepted') AS reason, CAST(sum(n) AS BIGINT) AS units FROM units GROUP BY ALL"""


def _units_by_reason(rejected: DataFrame, kept: DataFrame) -> DataFrame:
    kept = kept.select(I.price_symbol(F.col("ticker")).alias("symbol"), F.lit("accepted").alias("reason"))
    return rejected.select("symbol", "reason").unionByName(kept).groupBy("symbol", "reason").agg(F.count(F.lit(1)).alias("units"))


@register("ingest_rejects", _oracle(["bronze_prices"], [], _REJECTS_SQL))
def q_ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty documents and entries are set aside with their reason; accepted and rejected add up to what landed."""
    lines = _faulty_lines(spark, sf_dir).withColumn("file", F.lit(None).cast("string"))
    units = checkpointed(I.check_payloads(lines, I.PRICE_FEED))
    return _units_by_reason(I.rejects(units), I.accepted(units, I.PRICE_FEED))


@register("stream_rejects", _oracle(["bronze_prices"], [], _REJECTS_SQL + """
UNION ALL SELECT 'all', 'landed', CAST(sum(n) AS BIGINT) FROM units
UNION ALL SELECT 'all', 'accepted', CAST(coalesce(sum(n) FILTER (reason IS NULL), 0) AS BIGINT) FROM units"""))
def q_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1, S5: the same documents as files of a stream in two micro-batches: bronze, the rejects table and the batches' counts."""
    import uuid

    from quantleaf.session import scratch_path
    from quantleaf.streaming import incremental as N
    run = scratch_path(spark, f"stream-rejects-{uuid.uuid4().hex}")
    lines = checkpointed(_faulty_lines(spark, sf_dir))
    for k in (0, 1):
        lines.where(F.pmod(F.col("fetch_seq"), F.lit(2)) == k).select("value").write.mode("append").options(**I.LANDED).text(f"{run}/landing")
        N.run_price_ingest(spark, f"{run}/landing", f"{run}/bronze", f"{run}/checkpoint", mode="all")
    counts = spark.read.parquet(f"{run}/bronze" + N.COUNTS_SUFFIX).agg(F.sum("landed").alias("landed"), F.sum("accepted").alias("accepted"))
    totals = counts.select(F.explode(F.map_from_arrays(F.array(F.lit("landed"), F.lit("accepted")), F.array("landed", "accepted")))
                           .alias("reason", "units")).select(F.lit("all").alias("symbol"), "reason", "units")
    return _units_by_reason(spark.read.parquet(f"{run}/bronze" + N.REJECTS_SUFFIX), N.bronze_rows(spark, f"{run}/bronze")).unionByName(totals)


def _feeds_sql() -> str:
    """Three feeds by document: each appends the rows whose key the earlier ones did not store."""
    feed = "SELECT * FROM payload_rows WHERE feed = {} "
    unseen = "AND (ticker, trade_date) NOT IN (SELECT (ticker, trade_date) FROM payload_rows WHERE feed < {})"
    parts = [feed.format(k) + (unseen.format(k) if k else "") for k in range(3)]
    rows = _PAYLOAD_SQL.strip().replace("\nFROM bronze_prices", ", fetch_seq % 3 AS feed\nFROM bronze_prices")
    return f", payload_rows AS ({rows})\nSELECT * EXCLUDE (feed) FROM (" + "\nUNION ALL ".join(parts) + ")"


@register("stream_ingest", _oracle(["bronze_prices"], [], _feeds_sql()))
def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1: payload files landed in the shared folder, ingested by Structured Streaming (AvailableNow + foreachBatch
    duplicate check), bronze read back. Two landings of one feed overlap in their keys (two micro-batches of one
    checkpoint); a second feed with a checkpoint of its own overlaps with both."""
    import uuid

    from quantleaf.session import scratch_path
    from quantleaf.streaming.incremental import bronze_rows, run_price_ingest
    run = scratch_path(spark, f"stream-ingest-{uuid.uuid4().hex}")
    bronze = f"{run}/bronze"
    docs = proxy_payloads(spark, sf_dir).withColumn("feed", F.pmod(F.col("fetch_seq"), F.lit(3)))
    for k, feed in enumerate(("first", "first", "second")):
        docs.where(F.col("feed") == k).drop("feed", "fetch_seq").write.mode("append").options(**I.LANDED).json(f"{run}/landing-{feed}")
        run_price_ingest(spark, f"{run}/landing-{feed}", bronze, f"{run}/checkpoint-{feed}", mode="anti")
    return bronze_rows(spark, bronze)


@register("silver_incremental", _oracle(["silver_prices"], [], "SELECT * FROM silver_prices"))
def q_silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1, §2.10: silver prices built from three feeds (dealt by fetch, so later ones correct earlier days and fill gaps),
    each changing its own time buckets only; equal to a full rebuild."""
    import uuid

    from quantleaf.plans import incremental_silver as N
    from quantleaf.session import scratch_path
    b = proxy.load(spark, sf_dir)
    out = scratch_path(spark, f"incremental-{uuid.uuid4().hex}")
    third = F.when(F.year("trade_date") < 1996, 1).when(F.pmod(F.col("fetch_seq"), F.lit(5)) == 0, 2).otherwise(0)
    prices = checkpointed(b.prices.withColumn("feed", third))
    for k in range(3):
        feed = prices.where(F.col("feed") == k).drop("feed")
        version = N.apply_feed(spark, feed, out, EngineConfig(), b.price_order, b.order_digits["prices"])
    return N.silver_prices(version)


_CROSS_SQL = """
, u AS (SELECT trade_date, CAST(close_rate AS DOUBLE) AS r FROM silver_forex WHERE currency_pair = 'USD/INR' AND close_rate > 0),
one AS (SELECT trade_date, 1.0 / r AS rate FROM u)
SELECT 'INR' AS currency, trade_date, CAST(rate AS DECIMAL(18,6)) AS rate, 'INR-USD' AS path, 1 AS steps FROM one
UNION ALL
SELECT split_part(currency_pair, '/', 1), f.trade_date, CAST(CAST(close_rate AS DOUBLE) * rate AS DECIMAL(18,6)),
       split_part(currency_pair, '/', 1) || '-INR-USD', 2
FROM silver_forex f JOIN one USING (trade_date) WHERE currency_pair <> 'USD/INR' AND close_rate > 0"""


@register("cross_rates_usd", _oracle(["silver_forex"], [], _CROSS_SQL))
def q_cross_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates to a base that most currencies have no quote with, through the pairs quoted that day, with the path."""
    return cross_rates(layers(spark, sf_dir).silver.forex, "USD")


# Closed days of each exchange besides weekends (month, day), every year.
_HOLIDAYS = {"NYSE": [(1, 1), (7, 4), (12, 25)], "LSE": [(1, 1), (12, 25), (12, 26)], "XETRA": [(1, 1), (5, 1), (12, 24), (12, 25), (12, 31)],
             "NSE": [(1, 26), (8, 15), (10, 2)]}
_CALENDAR_SQL = """
holidays AS (SELECT * FROM (VALUES """ + ", ".join(f"('{x}', {m}, {d})" for x, days in _HOLIDAYS.items() for m, d in days) + """) t(exchange, m, d)),
bounds AS (SELECT MIN(trade_date) AS a, MAX(trade_date) AS b FROM silver_prices),
all_days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date_key FROM bounds),
open_days AS (
  SELECT exchange, date_key, row_number() OVER (PARTITION BY exchange ORDER BY date_key) AS k
  FROM (SELECT DISTINCT exchange FROM companies), all_days
  WHERE dayofweek(date_key) NOT IN (0, 6) AND NOT EXISTS (
    SELECT 1 FROM holidays h WHERE h.exchange = companies.exchange AND h.m = month(date_key) AND h.d = day(date_key)))""".replace(
    "companies.exchange AND", "x.exchange AND").replace("(SELECT DISTINCT exchange FROM companies), all_days", "(SELECT DISTINCT exchange FROM companies) x, all_days").replace(
    "SELECT exchange, date_key, row_number() OVER (PARTITION BY exchange", "SELECT x.exchange, date_key, row_number() OVER (PARTITION BY x.exchange")


def _trading_calendar(spark: SparkSession, s: P.StoredSilver) -> DataFrame:
    """Trading days of the exchanges over the price history (two scalars); holidays by rule."""
    start, end = s.prices.agg(F.min("trade_date"), F.max("trade_date")).first()
    rules = spark.createDataFrame([(x, m, d) for x, days in _HOLIDAYS.items() for m, d in days], "exchange string, m int, d int")
    holidays = rules.select("exchange", F.explode(F.sequence(F.lit(start.year), F.lit(end.year))).alias("y"), "m", "d").select(
        "exchange", F.make_date("y", "m", "d").alias("date_key"))
    return TD.trading_calendar(s.companies, holidays, start, end)


@register("freshness_by_exchange", _oracle(["silver_prices", "companies"], [_CALENDAR_SQL], """
SELECT c.ticker, c.exchange, last_date, expected_date,
       CAST(greatest((SELECT COUNT(*) FROM open_days o WHERE o.exchange = c.exchange AND o.date_key <= expected_date)
            - (SELECT COUNT(*) FROM open_days o WHERE o.exchange = c.exchange AND o.date_key <= last_date), 0) AS INTEGER) AS trading_days_behind,
       coalesce(last_date >= expected_date, FALSE) AS is_fresh
FROM companies c
LEFT JOIN (SELECT ticker, MAX(trade_date) AS last_date FROM silver_prices WHERE trade_date <= DATE '1998-12-28' GROUP BY ticker) USING (ticker)
LEFT JOIN (SELECT exchange, MAX(date_key) AS expected_date FROM open_days WHERE date_key < DATE '1998-12-28' GROUP BY exchange) USING (exchange)"""))
def q_freshness_by_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On the Monday after Christmas 1998, against the last day each exchange was open."""
    import datetime as dt
    s = layers(spark, sf_dir).silver
    return TD.freshness_by_exchange(s.prices, s.companies, _trading_calendar(spark, s), dt.date(1998, 12, 28))


@register("trading_gaps", _oracle(["silver_prices", "companies"], [_CALENDAR_SQL], """
SELECT ticker, exchange, first_date, last_date, (SELECT COUNT(*) FROM open_days o WHERE o.exchange = g.exchange AND o.date_key BETWEEN first_date AND last_date) AS trading_days,
       CAST(priced AS BIGINT) AS priced_days,
       (SELECT COUNT(*) FROM open_days o WHERE o.exchange = g.exchange AND o.date_key BETWEEN first_date AND last_date) - CAST(priced AS BIGINT) AS missing_days,
       CAST(n - priced AS BIGINT) AS closed_day_prices
FROM (SELECT p.ticker, c.exchange, MIN(trade_date) AS first_date, MAX(trade_date) AS last_date, COUNT(*) AS n, COUNT(o.k) AS priced
      FROM silver_prices p JOIN companies c USING (ticker) LEFT JOIN open_days o ON o.exchange = c.exchange AND o.date_key = p.trade_date
      GROUP BY ALL) g"""))
def q_trading_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: trading days without a price, and prices on closed days, per ticker."""
    s = layers(spark, sf_dir).silver
    return TD.trading_gaps(s.prices, s.companies, _trading_calendar(spark, s))


_KNOWN_ON = ("1996-06-30", "1998-12-31")
# A report is fetched 10 to 209 days after its date.
_KNOWN_SQL = """
, fetches AS (SELECT f.*, CAST(report_date + CAST(10 + fetch_seq % 200 AS INTEGER) AS DATE) AS fetched_on,
                     CAST(last_day(date_trunc('quarter', report_date) + INTERVAL 2 MONTH) AS DATE) AS quarter_end FROM bronze_fund f)
SELECT CAST(known_on AS DATE) AS known_on, ticker, quarter_end, last.report_date, last.fetched_on, last.revenue, last.net_profit
FROM (SELECT known_on, ticker, quarter_end,
             max({'seq': fetch_seq, 'report_date': report_date, 'fetched_on': fetched_on, 'revenue': revenue, 'net_profit': net_profit}) AS last
      FROM fetches JOIN (VALUES (DATE '1996-06-30'), (DATE '1998-12-31')) k(known_on) ON fetched_on <= known_on GROUP BY ALL)"""


@register("fundamentals_known_on", _oracle(["bronze_fund"], [], _KNOWN_SQL))
def q_fundamentals_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarterly figures as they were known on two days."""
    import datetime as dt
    rows = proxy.bronze_fundamentals(spark, sf_dir).withColumn("fetched_on", F.date_add("report_date", (10 + F.col("fetch_seq") % 200).cast("int")))
    return S.known_quarters(rows, [dt.date.fromisoformat(d) for d in _KNOWN_ON], ["fetch_seq"], ["report_date", "fetched_on", "revenue", "net_profit"],
                            digits=proxy.Bronze.order_digits["fundamentals"])


# Planted faults: no ticker, a second row of a key, a high below the low.
_GATE_SQL = """
, planted AS (
  SELECT CASE WHEN volume % 17 = 3 THEN NULL ELSE ticker END AS ticker, trade_date,
         CASE WHEN day(trade_date) = 9 THEN low_price - 1 ELSE high_price END AS high_price, low_price FROM silver_prices
  UNION ALL SELECT ticker, trade_date, high_price, low_price FROM silver_prices WHERE day(trade_date) = 13),
judged AS (
  SELECT *, (CASE WHEN ticker IS NOT NULL AND count(*) OVER (PARTITION BY ticker, trade_date) > 1 THEN 'duplicate key; ' ELSE '' END)
         || (CASE WHEN ticker IS NULL THEN 'ticker is NULL; ' ELSE '' END) || (CASE WHEN high_price < low_price THEN 'high below low; ' ELSE '' END) AS broken
  FROM planted)
SELECT CASE WHEN broken = '' THEN 'accepted' ELSE broken[:-3] END AS outcome, COUNT(*) AS row_count FROM judged GROUP BY ALL"""


@register("constraint_gate", _oracle(["silver_prices"], [], _GATE_SQL))
def q_constraint_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key, of a duplicated key or out of range are set aside with the rules they broke; the rest is
    published."""
    import uuid
    from dataclasses import replace

    from quantleaf.operators.gates import SILVER_GATES
    from quantleaf.session import scratch_path
    p = layers(spark, sf_dir).silver.prices.select("ticker", "trade_date", "high_price", "low_price", "volume")
    planted = p.withColumn("ticker", F.when(F.pmod("volume", F.lit(17)) != 3, F.col("ticker"))).withColumn(
        "high_price", F.when(F.dayofmonth("trade_date") == 9, (F.col("low_price") - 1).cast(schemas.D18_4)).otherwise(F.col("high_price")))
    planted = planted.unionByName(p.where(F.dayofmonth("trade_date") == 13)).drop("volume")
    out = scratch_path(spark, f"gate-{uuid.uuid4().hex}")
    with versions.building(spark, out) as build:
        build.write_gated("prices", planted, replace(SILVER_GATES["silver_stock_prices"], max_share=0.5))
        version = build.publish()
    rejected = version.table("prices__rejected").select(F.concat_ws("; ", "violations").alias("outcome"))
    return (rejected.unionByName(version.table("prices").select(F.lit("accepted").alias("outcome")))
            .groupBy("outcome").agg(F.count(F.lit(1)).alias("row_count")))


# ----------------------------------------------------------------------------- stored states

_ORACLE_PAIR_COUNT = _oracle(["silver_prices", "companies"], [_CORR_SQL], """
SELECT n, pairs, CAST(n * (n - 1) / 2 AS BIGINT) AS expected_pairs, pairs = CAST(n * (n - 1) / 2 AS BIGINT) AS complete
FROM (SELECT (SELECT COUNT(DISTINCT ticker) FROM silver_prices WHERE daily_return_pct IS NOT NULL) AS n,
             (SELECT COUNT(*) FROM paired) AS pairs) x""")

_RANGE = ("1995-03-10", "1999-10-20")
_IN_RANGE = f"FROM daily WHERE trade_date BETWEEN DATE '{_RANGE[0]}' AND DATE '{_RANGE[1]}'"


def _range_states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The month states of the stored daily table that make up a range cut inside two months, and the companies."""
    import datetime as dt
    import uuid

    from quantleaf.session import scratch_path
    L = layers(spark, sf_dir)
    out = scratch_path(spark, f"states-{uuid.uuid4().hex}")
    with versions.building(spark, out) as build:
        daily = build.write("daily", _daily(L).sortWithinPartitions("trade_date"))
        states = build.write("month_states", PS.month_states(daily))
        build.publish()
    return PS.of_range(states, daily, *map(dt.date.fromisoformat, _RANGE)), L.silver.companies


@register("period_returns_from_states", _oracle(_GOLD_BASE, [_DAILY_SQL, _PR_SQL.replace("FROM daily", _IN_RANGE)], """
SELECT period, ticker, first_close, last_close, local_return_pct, inr_return_pct,
       CAST(inr_return_pct - local_return_pct AS DECIMAL(18,4)) AS currency_impact_pct
FROM pr"""))
def q_period_returns_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date range answered from month states and the rows of its two cut months."""
    return PS.period_returns(_range_states(spark, sf_dir)[0])


@register("category_volatility_from_states", _oracle(_GOLD_BASE, [_DAILY_SQL], f"""
SELECT v.period, c.category, {avg_dec('v.volatility', 4, 'avg_volatility')}, COUNT(v.volatility) AS ticker_count
FROM (SELECT CAST(year(trade_date) AS INTEGER) AS period, ticker,
             CAST(STDDEV_POP(CAST(daily_return_local_pct AS DOUBLE)) AS DECIMAL(18,4)) AS volatility
      {_IN_RANGE} GROUP BY year(trade_date), ticker) v
JOIN companies c ON v.ticker = c.ticker GROUP BY v.period, c.category"""))
def q_category_volatility_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M19 from the same states."""
    return PS.category_volatility(*_range_states(spark, sf_dir))


def _stored_moments(spark: SparkSession, sf_dir: str) -> tuple[versions.Version, Layers]:
    """Pair moments of the history but for its last day, then brought up to date with that day's chunk."""
    import uuid

    from quantleaf.session import scratch_path
    L = layers(spark, sf_dir)
    out = scratch_path(spark, f"moments-{uuid.uuid4().hex}")
    last = L.silver.as_of
    pair_store.update(spark, L.silver.prices.where(F.col("trade_date") < F.lit(last)), L.silver.companies, out, L.cfg)
    return pair_store.update(spark, L.silver.prices, L.silver.companies, out, L.cfg, [last]), L


@register("correlation_from_moments", _oracle(["silver_prices", "companies"], [_CORR_SQL], _CORR_TAIL))
def q_correlation_from_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 from stored moments, of which the last day changed one chunk."""
    version, L = _stored_moments(spark, sf_dir)
    return pair_store.correlation_matrix(version, L.silver.companies, L.cfg)


@register("pair_count_from_moments", _ORACLE_PAIR_COUNT)
def q_pair_count_from_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7 from stored moments: no product."""
    version, L = _stored_moments(spark, sf_dir)
    return pair_store.pair_count(version, L.silver.prices)


# ----------------------------------------------------------------------------- quality

@register("row_counts", _oracle(_GOLD_BASE, [_STATS_SQL, _PERF_SQL, _DAILY_SQL], """
SELECT 'silver_stock_prices' AS table_name, COUNT(*) AS row_count FROM silver_prices
UNION ALL SELECT 'silver_stock_fundamentals', COUNT(*) FROM silver_fund
UNION ALL SELECT 'silver_forex_rates', COUNT(*) FROM silver_forex
UNION ALL SELECT 'gold_stock_performance', COUNT(*) FROM perf
UNION ALL SELECT 'gold_daily_inr_returns', COUNT(*) FROM daily"""))
def q_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts per layer table."""
    L = layers(spark, sf_dir)
    s = L.silver
    return Q.row_counts({"silver_stock_prices": s.prices, "silver_stock_fundamentals": s.fundamentals,
                         "silver_forex_rates": s.forex,
                         "gold_stock_performance": P.stock_performance(L.gold()),
                         "gold_daily_inr_returns": _daily(L)})


@register("ticker_coverage", _oracle(["silver_prices"], [], """
SELECT ticker, COUNT(*) AS row_count, MIN(trade_date) AS first_date, MAX(trade_date) AS last_date
FROM silver_prices GROUP BY ticker"""))
def q_ticker_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4."""
    return Q.coverage(layers(spark, sf_dir).silver.prices, "ticker")


@register("freshness", _oracle(["silver_prices", "as_of"], [], """
, e AS (SELECT CAST(d - CASE dayofweek(d) WHEN 1 THEN 3 WHEN 0 THEN 2 ELSE 1 END AS DATE) AS expected FROM as_of)
SELECT ticker, MAX(trade_date) AS last_date, e.expected AS expected_date,
       CAST(e.expected - MAX(trade_date) AS INTEGER) AS days_behind, MAX(trade_date) >= e.expected AS is_fresh
FROM silver_prices, e GROUP BY ticker, e.expected"""))
def q_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: last date per ticker vs the previous trading day."""
    L = layers(spark, sf_dir)
    return Q.freshness(L.silver.prices, "ticker", L.cfg.as_of)


@register("key_violations", _oracle(["silver_prices", "silver_forex"], [], """
, kv AS (
  SELECT 'bronze_stock_prices' AS table_name, ticker IS NULL OR trade_date IS NULL AS has_null, COUNT(*) AS c
  FROM bronze_prices GROUP BY ticker, trade_date
  UNION ALL
  SELECT 'silver_stock_prices', ticker IS NULL OR trade_date IS NULL, COUNT(*) FROM silver_prices GROUP BY ticker, trade_date
  UNION ALL
  SELECT 'silver_forex_rates', currency_pair IS NULL OR trade_date IS NULL, COUNT(*) FROM silver_forex
  GROUP BY currency_pair, trade_date)
SELECT table_name, CAST(SUM(CASE WHEN c > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_keys,
       CAST(COALESCE(SUM(CASE WHEN c > 1 THEN c END), 0) AS BIGINT) AS duplicate_rows,
       CAST(COALESCE(SUM(CASE WHEN has_null THEN c END), 0) AS BIGINT) AS null_keys
FROM kv GROUP BY table_name"""))
def q_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 / V2: duplicated and NULL keys in bronze (expected: duplicates) and silver (expected: none)."""
    L = layers(spark, sf_dir)
    return (Q.key_violations(L.bronze.prices, ["ticker", "trade_date"], "bronze_stock_prices")
            .unionByName(Q.key_violations(L.silver.prices, ["ticker", "trade_date"], "silver_stock_prices"))
            .unionByName(Q.key_violations(L.silver.forex, ["currency_pair", "trade_date"], "silver_forex_rates")))


@register("return_outliers", _oracle(["silver_prices"], [], """
SELECT ticker, COUNT(daily_return_pct) AS returns,
       CAST(SUM(CASE WHEN daily_return_pct < -5 OR daily_return_pct > 5 THEN 1 ELSE 0 END) AS BIGINT) AS outside_range,
       MIN(daily_return_pct) AS min_return_pct, MAX(daily_return_pct) AS max_return_pct
FROM silver_prices GROUP BY ticker"""))
def q_return_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6: daily returns outside ±5 %."""
    return Q.return_outliers(layers(spark, sf_dir).silver.prices)


@register("home_rate_check", _oracle(_GOLD_BASE, [_DAILY_SQL], """
SELECT CAST(SUM(CASE WHEN currency_pair IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS home_rows,
       CAST(SUM(CASE WHEN currency_pair IS NULL AND forex_rate <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS bad_rate_rows
FROM daily"""))
def q_home_rate_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8: home-currency rows carry rate 1."""
    return Q.home_rate_check(_daily(layers(spark, sf_dir)))


@register("unit_conversion_check", _oracle(["silver_prices"], [], """
SELECT d.ticker, d.currency, COUNT(*) AS rows,
       CAST(MIN(CAST(s.close_price AS DOUBLE) / CAST(d.close_price AS DOUBLE)) AS DECIMAL(18,6)) AS min_ratio,
       CAST(MAX(CAST(s.close_price AS DOUBLE) / CAST(d.close_price AS DOUBLE)) AS DECIMAL(18,6)) AS max_ratio
FROM dedup_prices d JOIN silver_prices s ON d.ticker = s.ticker AND d.trade_date = s.trade_date
WHERE d.currency IN ('GBp') GROUP BY d.ticker, d.currency"""))
def q_unit_conversion_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9: silver/bronze close ratio for minor-unit tickers (expected 0.01)."""
    L = layers(spark, sf_dir)
    b = latest_by_key(L.bronze.prices, ["ticker", "trade_date"], L.bronze.price_order, ["close_price", "currency"])
    r = Q.unit_conversion_check(b, L.silver.prices, L.cfg.minor_units)
    return r.select("ticker", "currency", "rows",
                    G.X.to_dec(F.col("min_ratio").cast("double"), 18, 6).alias("min_ratio"),
                    G.X.to_dec(F.col("max_ratio").cast("double"), 18, 6).alias("max_ratio"))


@register("pair_count_check", _ORACLE_PAIR_COUNT)
def q_pair_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: correlation pairs vs n(n−1)/2."""
    L = layers(spark, sf_dir)
    return Q.pair_count_check(P.correlation(L.gold()), L.silver.prices)


@register("short_history_check", _oracle(_GOLD_BASE, [_STATS_SQL.replace(
    "WHERE trade_date <= d)", f"WHERE trade_date <= d AND NOT (ticker = '{proxy.SHORT_HISTORY_TICKER}' AND trade_date < "
    f"DATE '{proxy.SHORT_HISTORY_START}'))"), _PERF_SQL], """
SELECT ticker, earliest_date, yoy_return_pct, yoy_return_pct IS NOT NULL AS has_return
FROM stats JOIN perf USING (ticker) WHERE year_ago_price IS NULL AND stats.current_price IS NOT NULL"""))
def q_short_history_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short-history tickers still get a return. The listing date of one ticker is set later here, for this check only."""
    from dataclasses import replace
    L = layers(spark, sf_dir)
    silver = L.silver.tables()
    g = P.gold_inputs(replace(silver, prices=proxy.late_listing(silver.prices)), L.cfg)
    return Q.short_history_check(P.stock_performance(g), g.stats)


# ----------------------------------------------------------------------------- stored-procedure variant

_SP = EngineConfig(reference_variant="sp")


def _sp_gold(spark: SparkSession, sf_dir: str) -> P.GoldInputs:
    return layers(spark, sf_dir, _SP).gold()


_PERF_SP_SQL = """
perf_sp AS (
  SELECT ticker, company_name, category, region, currency, CAST(current_price AS DECIMAL(18,4)) AS current_price,
         CAST(yoy_raw AS DECIMAL(18,4)) AS yoy_return_pct, CAST(year_high AS DECIMAL(18,4)) AS week_52_high,
         CAST(year_low AS DECIMAL(18,4)) AS week_52_low, CAST(year_deviation AS DECIMAL(18,4)) AS volatility,
         CAST((CAST(current_price AS DOUBLE) - CAST(base_price AS DOUBLE)) / NULLIF(CAST(base_price AS DOUBLE), 0) * 100
              / NULLIF(year_deviation, 0) AS DECIMAL(18,4)) AS sharpe_ratio,
         pe_ratio, market_cap, roe, debt_to_equity, dividend_yield
  FROM companies JOIN stats USING (ticker) JOIN silver_fund USING (ticker) WHERE year_rows > 0)"""

_CUR_SP_SQL = f"""
cur_sp AS (
  SELECT ticker, company_name, category, region, currency AS original_currency, local AS return_local_pct,
         first_rate AS inr_start_rate, last_rate AS inr_end_rate, {_currency_effect("currency = 'INR'")}
  FROM (SELECT *
        FROM (SELECT companies.*, yoy_return_pct AS local,
                     CAST(CASE WHEN companies.currency = 'INR' THEN 1 ELSE start_rate END AS DECIMAL(18,6)) AS first_rate,
                     CAST(CASE WHEN companies.currency = 'INR' THEN 1 ELSE end_rate END AS DECIMAL(18,6)) AS last_rate
              FROM companies JOIN perf_sp USING (ticker) LEFT JOIN currency_map ON companies.currency = currency_code
              LEFT JOIN pair_rates USING (forex_pair))))"""


@register("gold_stock_performance_sp", _oracle(_GOLD_BASE, [_STATS_SQL, _PERF_SP_SQL], "SELECT * FROM perf_sp"))
def q_gold_stock_performance_sp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6, stored-procedure variant (one-year window, inner joins, Sharpe on the raw stdev)."""
    return P.stock_performance(_sp_gold(spark, sf_dir))


@register("gold_currency_adjusted_returns_sp",
          _oracle(_GOLD_BASE, [_STATS_SQL, _PERF_SP_SQL, _FXS_SQL, _CUR_SP_SQL], "SELECT * FROM cur_sp"))
def q_gold_currency_adjusted_returns_sp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7, stored-procedure variant (home = currency code, NULL missing rates, C9 / C23)."""
    return P.currency_adjusted(_sp_gold(spark, sf_dir))


# A NULL return is last among the best and first among the worst.
_CAT_SP_TAIL = f"""
SELECT category, {_AVERAGES}, coalesce({_BEST}, min(ticker)) AS best_stock,
       coalesce(min(ticker) FILTER (yoy_return_pct IS NULL), {_WORST}) AS worst_stock, {_TOTALS}
FROM perf_sp GROUP BY category"""


@register("gold_category_performance_sp", _oracle(_GOLD_BASE, [_STATS_SQL, _PERF_SP_SQL], _CAT_SP_TAIL))
def q_gold_category_performance_sp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8, stored-procedure variant (a NULL return sorts first for the worst stock, C13)."""
    g = _sp_gold(spark, sf_dir)
    return G.category_performance(P.stock_performance(g), g.cfg)


_REGION_SP_TAIL = f"""
, leaders AS (SELECT region, coalesce({_FIRST_CATEGORY % ("yoy_return_pct", "yoy_return_pct")}, min(category)) AS best_category
              FROM perf_sp GROUP BY region)
SELECT region, {avg_dec('yoy_return_pct', 4, 'avg_yoy_return_pct')}, {avg_dec('volatility', 4, 'avg_volatility')},
       {avg_dec('sharpe_ratio', 4, 'avg_sharpe_ratio')}, CAST(COUNT(ticker) AS INTEGER) AS stock_count, best_category,
       {avg_dec('currency_impact_pct', 4, 'avg_currency_impact_pct')}
FROM perf_sp JOIN (SELECT ticker, currency_impact_pct FROM cur_sp) USING (ticker) JOIN leaders USING (region)
GROUP BY region, best_category"""


@register("gold_region_performance_sp",
          with_ctes(_GOLD_BASE, [_STATS_SQL, _PERF_SP_SQL, _FXS_SQL, _CUR_SP_SQL]).rstrip() + _REGION_SP_TAIL)
def q_gold_region_performance_sp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9, stored-procedure variant (best category of the best stock, inner join, C14 / C15)."""
    g = _shared(_sp_gold(spark, sf_dir))
    return G.region_performance(P.stock_performance(g), P.currency_adjusted(g), g.cfg)


# The payout is exact: dividend in 1/10000 over whole earnings per share, rounded half away from zero in integers.
_DIV_SP_TAIL = """
SELECT ticker, company_name, category, region, CAST(price AS DECIMAL(18,4)) AS stock_price,
       CAST(dividend_per_share AS DECIMAL(18,4)) AS annual_dividend, CAST(dividend_yield AS DECIMAL(18,6)) AS dividend_yield_pct,
       CASE WHEN eps <> 0 THEN CAST(CAST(SIGN(units) * SIGN(eps) * ((2 * ABS(units) + ABS(eps)) // (2 * ABS(eps))) AS DECIMAL(38,0))
                                    * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4)) END AS payout_ratio,
       CAST(CASE WHEN currency = 'INR' THEN CAST(dividend_per_share AS DECIMAL(38,10))
                 ELSE CAST(dividend_per_share AS DECIMAL(28,4)) * end_rate END AS DECIMAL(18,4)) AS dividend_in_inr,
       dividend_yield IS NOT NULL AS pays_dividend
FROM (SELECT companies.*, stats.current_price AS price, silver_fund.* EXCLUDE (ticker),
             net_profit // NULLIF(shares_outstanding, 0) AS eps, CAST(dividend_per_share * 10000 AS HUGEINT) AS units
      FROM companies JOIN silver_fund USING (ticker) JOIN stats USING (ticker)
      WHERE ticker IN (SELECT ticker FROM perf_sp))
LEFT JOIN currency_map ON currency = currency_code LEFT JOIN pair_rates USING (forex_pair)"""


@register("gold_dividend_analysis_sp", _oracle(_GOLD_BASE, [_STATS_SQL, _PERF_SP_SQL, _FXS_SQL], _DIV_SP_TAIL))
def q_gold_dividend_analysis_sp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10, stored-procedure variant (BIGINT/BIGINT EPS, NULL home value for non-payers, C16–C18)."""
    return P.dividend(_sp_gold(spark, sf_dir))


_CORR_SP_TAIL = _corr_tail("r", "'Negative'", "JOIN")


@register("gold_correlation_matrix_sp",
          with_ctes(["silver_prices", "companies"], [_CORR_SQL]).rstrip() + _CORR_SP_TAIL)
def q_gold_correlation_matrix_sp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11, stored-procedure variant (raw-value buckets, NULL → 'Negative', inner joins, C11 / C22)."""
    return P.correlation(_sp_gold(spark, sf_dir))


_DAILY_SP_SQL = _daily_sql(f"coalesce(fx.close_rate, {_ONE})", _SAME_DAY, pair="fx.currency_pair")


@register("gold_daily_inr_returns_sp", _oracle(_GOLD_BASE, [_DAILY_SP_SQL], "SELECT * FROM daily"))
def q_gold_daily_inr_returns_sp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12, stored-procedure variant (currency_pair of the matched FX row, C19)."""
    L = layers(spark, sf_dir, _SP)
    s = L.silver
    return G.daily_inr_returns(s.prices, s.forex, s.companies, s.currency_map, L.cfg)


def _listing_sql() -> str:
    """Oracle for layer_listing: row counts plus the declared column order of each table."""
    cols = {
        "silver_stock_prices": ["ticker", "trade_date", "open_price", "high_price", "low_price", "close_price",
                                "volume", "daily_return_pct", "is_valid"],
        "silver_forex_rates": ["currency_pair", "trade_date", "close_rate", "daily_change_pct", "is_valid"],
        "gold_stock_performance": ["ticker", "company_name", "category", "region", "currency", "current_price",
                                   "yoy_return_pct", "week_52_high", "week_52_low", "volatility", "sharpe_ratio",
                                   "pe_ratio", "market_cap", "roe", "debt_to_equity", "dividend_yield"],
    }
    layer = {"silver_stock_prices": "silver", "silver_forex_rates": "silver", "gold_stock_performance": "gold"}
    values = ", ".join(f"('{layer[t]}', '{t}', {i}, '{c}')" for t, cs in cols.items() for i, c in enumerate(cs))
    counts = """
, rc AS (SELECT 'silver_stock_prices' AS table_name, COUNT(*) AS row_count FROM silver_prices
         UNION ALL SELECT 'silver_forex_rates', COUNT(*) FROM silver_forex
         UNION ALL SELECT 'gold_stock_performance', COUNT(*) FROM perf),
meta AS (SELECT * FROM (VALUES """ + values + """) t(layer, table_name, ordinal, column_name))
SELECT m.layer, m.table_name, rc.row_count, COUNT(*) AS column_count,
       string_agg(m.column_name, ', ' ORDER BY m.ordinal) AS columns
FROM meta m JOIN rc ON m.table_name = rc.table_name
GROUP BY m.layer, m.table_name, rc.row_count"""
    return with_ctes(_GOLD_BASE, [_STATS_SQL, _PERF_SQL]).rstrip() + counts


@register("layer_listing", _listing_sql())
def q_layer_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layer tables with row counts and their column lists."""
    L = layers(spark, sf_dir)
    tables = {"silver_stock_prices": L.silver.prices, "silver_forex_rates": L.silver.forex,
              "gold_stock_performance": P.stock_performance(L.gold())}
    return Q.layer_listing(tables, {"silver_stock_prices": "silver", "silver_forex_rates": "silver",
                                    "gold_stock_performance": "gold"})


# ----------------------------------------------------------------------------- options, slicers, refresh

@register("gold_currency_adjusted_returns_one", _oracle(_GOLD_BASE, [_STATS_SQL, _FXS_SQL, _CUR_SQL.replace(
    "THEN 1 ELSE start_rate END", "THEN 1 ELSE coalesce(start_rate, 1) END").replace(
    "THEN 1 ELSE end_rate END", "THEN 1 ELSE coalesce(end_rate, 1) END")], "SELECT * FROM cur"))
def q_currency_adjusted_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 with ``fx_start_default_one``: a missing rate counts as 1."""
    return P.currency_adjusted(layers(spark, sf_dir, EngineConfig(fx_start_default_one=True)).gold())


_MIN_OBS = 930


@register("gold_correlation_min_obs", _oracle(["silver_prices", "companies"], [_CORR_SQL.replace(
    "GROUP BY ALL)", f"GROUP BY a.ticker, b.ticker HAVING count(*) > {_MIN_OBS})")], _CORR_TAIL))
def q_correlation_min_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 over pairs with more than ``min_obs`` common days."""
    return P.correlation(layers(spark, sf_dir, EngineConfig(min_obs=_MIN_OBS)).gold())


@register("leading_categories", _oracle(_GOLD_BASE, [_STATS_SQL, _PERF_SQL], f"""
SELECT category, {avg_dec('yoy_return_pct', 4, 'avg_yoy_return_pct')}, COUNT(yoy_return_pct) AS stocks
FROM perf GROUP BY category ORDER BY 2 DESC NULLS LAST, 1 LIMIT 3"""))
def q_leading_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: ORDER BY an aggregate, top 3."""
    return M.leading_categories(P.stock_performance(layers(spark, sf_dir).gold()))


_SLICED = """trade_date BETWEEN DATE '1995-03-01' AND DATE '1999-10-31' AND year(trade_date) IN (1995, 1997, 1999)
    AND ticker IN (SELECT ticker FROM companies WHERE category IN ('CAT_1', 'CAT_2'))"""


@register("period_returns_sliced", _oracle(_GOLD_BASE, [_DAILY_SQL, _PR_SQL.replace("FROM daily", f"FROM daily WHERE {_SLICED}")], """
SELECT period, ticker, first_close, last_close, local_return_pct, inr_return_pct,
       CAST(inr_return_pct - local_return_pct AS DECIMAL(18,4)) AS currency_impact_pct
FROM pr"""))
def q_period_returns_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15–M17 under the dashboard's slicers: category, years and date range."""
    import datetime as dt
    L = layers(spark, sf_dir)
    daily = M.slice_daily(_daily(L), None, [1995, 1997, 1999], dt.date(1995, 3, 1), dt.date(1999, 10, 31))
    return M.period_returns(M.slice_category(daily, L.silver.companies, ["CAT_1", "CAT_2"]))


@register("price_volume_sliced", _oracle(["silver_prices"], [], """
SELECT ticker, trade_date, close_price, volume FROM silver_prices
WHERE ticker IN ('Brand#11', 'Brand#12', 'Brand#3') AND trade_date >= DATE '1996-01-01' AND trade_date <= DATE '1998-12-31'"""))
def q_price_volume_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M25 for chosen tickers and dates: the slicers reach the silver scan."""
    import datetime as dt
    return M.price_volume_series(layers(spark, sf_dir).silver.prices, ["Brand#11", "Brand#12", "Brand#3"],
                                 dt.date(1996, 1, 1), dt.date(1998, 12, 31))


@register("forex_trend_sliced", _oracle(["silver_forex"], [], """
SELECT currency_pair, trade_date, close_rate, daily_change_pct FROM silver_forex
WHERE currency_pair IN ('USD/INR', 'JPY/INR') AND trade_date >= DATE '1996-01-01' AND trade_date <= DATE '1997-06-30'"""))
def q_forex_trend_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M26 for chosen pairs and dates."""
    import datetime as dt
    return M.forex_trend(layers(spark, sf_dir).silver.forex, ["USD/INR", "JPY/INR"], dt.date(1996, 1, 1), dt.date(1997, 6, 30))


@register("freshness_given_date", _oracle(["silver_prices"], [], """
SELECT ticker, MAX(trade_date) AS last_date, DATE '2024-05-31' AS expected_date,
       CAST(DATE '2024-05-31' - MAX(trade_date) AS INTEGER) AS days_behind, MAX(trade_date) >= DATE '2024-05-31' AS is_fresh
FROM silver_prices GROUP BY ticker"""))
def q_freshness_given_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5 on a given day (a Monday; the Friday before is expected): a stopped feed is reported."""
    import datetime as dt
    return Q.freshness(layers(spark, sf_dir).silver.prices, "ticker", dt.date(2024, 6, 3))


_EXPECTED_SQL = """
, n AS (SELECT (SELECT COUNT(*) FROM companies) AS c, (SELECT COUNT(DISTINCT category) FROM companies) AS cat,
               (SELECT COUNT(DISTINCT region) FROM companies) AS reg,
               (SELECT COUNT(*) FROM (SELECT DISTINCT ticker, trade_date FROM bronze_prices)) AS px,
               (SELECT COUNT(*) FROM (SELECT DISTINCT currency_pair, trade_date FROM bronze_forex)) AS fx,
               (SELECT COUNT(DISTINCT ticker) FROM bronze_fund) AS fund,
               (SELECT COUNT(*) FROM daily) AS d, (SELECT COUNT(*) FROM paired) AS pairs),
t AS (SELECT unnest([{'t': 'silver_stock_prices', 'n': px, 'e': px}, {'t': 'silver_forex_rates', 'n': fx, 'e': fx},
                     {'t': 'silver_stock_fundamentals', 'n': fund, 'e': fund}, {'t': 'gold_stock_performance', 'n': c, 'e': c},
                     {'t': 'gold_currency_adjusted_returns', 'n': c, 'e': c}, {'t': 'gold_dividend_analysis', 'n': c, 'e': c},
                     {'t': 'gold_category_performance', 'n': cat, 'e': cat}, {'t': 'gold_region_performance', 'n': reg, 'e': reg},
                     {'t': 'gold_daily_inr_returns', 'n': d, 'e': px}, {'t': 'gold_correlation_matrix', 'n': pairs, 'e': c * (c - 1) // 2}]) AS r FROM n)
SELECT r.t AS table_name, r.n AS row_count, CAST(r.e AS BIGINT) AS expected_rows, r.n = r.e AS as_expected FROM t"""


@register("refresh_all_counts", with_ctes(_GOLD_BASE, [_DAILY_SQL, _CORR_SQL]).rstrip() + _EXPECTED_SQL)
def q_refresh_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole refresh written to tables; each table's rows against the number expected from bronze."""
    import uuid

    from quantleaf.session import scratch_path
    b = proxy.load(spark, sf_dir)
    out = scratch_path(spark, f"refresh-{uuid.uuid4().hex}")
    gold = P.refresh_all(spark, b, out)
    version = versions.current(spark, out)
    tables = {n: version.table(n) for n in [*P.SILVER_TABLES[:3], *gold]}
    # Dimension and key counts of bronze: a handful of scalars.
    c = b.companies.agg(F.count(F.lit(1)).alias("c"), F.countDistinct("category").alias("cat"), F.countDistinct("region").alias("reg"))
    px = b.prices.agg(F.countDistinct("ticker", "trade_date").alias("px"))
    fx = b.forex.agg(F.countDistinct("currency_pair", "trade_date").alias("fx"))
    fund = b.fundamentals.agg(F.countDistinct("ticker").alias("fund"))
    counts = {k: v for df in (c, px, fx, fund) for k, v in df.first().asDict().items()}
    expected = {"silver_stock_prices": counts["px"], "silver_forex_rates": counts["fx"], "silver_stock_fundamentals": counts["fund"],
                "gold_stock_performance": counts["c"], "gold_currency_adjusted_returns": counts["c"], "gold_dividend_analysis": counts["c"],
                "gold_category_performance": counts["cat"], "gold_region_performance": counts["reg"],
                "gold_daily_inr_returns": counts["px"], "gold_correlation_matrix": counts["c"] * (counts["c"] - 1) // 2}
    return Q.counts_against_expected(tables, spark.createDataFrame(list(expected.items()), "table_name string, expected_rows long"))


_AFTER_FAILURE_SQL = """
SELECT 'silver_stock_prices' AS table_name, CAST(1 AS BIGINT) AS version, COUNT(*) AS row_count, CAST(SUM(close_price) AS DECIMAL(38,6)) AS figure FROM silver_prices
UNION ALL SELECT 'silver_forex_rates', 1, COUNT(*), CAST(SUM(close_rate) AS DECIMAL(38,6)) FROM silver_forex
UNION ALL SELECT 'gold_stock_performance', 1, COUNT(*), CAST(SUM(current_price) AS DECIMAL(38,6)) FROM perf
UNION ALL SELECT 'gold_daily_inr_returns', 1, COUNT(*), CAST(SUM(close_price_inr) AS DECIMAL(38,6)) FROM daily"""


def _wrong_unit(bronze: proxy.Bronze) -> proxy.Bronze:
    """The same bronze with a rate feed a hundred million times too high: silver holds it, the last gold table (M12) cannot."""
    out = proxy.Bronze(bronze.spark, bronze.sf_dir)
    out.forex = bronze.forex.withColumn("close_rate", (F.col("close_rate") * 100_000_000).cast(schemas.D18_6))
    return out


def _figures(version: versions.Version) -> DataFrame:
    """Row count and a sum of tables of one version."""
    figure = {"silver_stock_prices": "close_price", "silver_forex_rates": "close_rate", "gold_stock_performance": "current_price",
              "gold_daily_inr_returns": "close_price_inr"}
    parts = [version.table(n).agg(F.lit(n).alias("table_name"), F.lit(version.number).cast("long").alias("version"),
                                  F.count(F.lit(1)).alias("row_count"), F.sum(c).cast("decimal(38,6)").alias("figure"))
             for n, c in figure.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _failed_refresh(spark: SparkSession, bronze: proxy.Bronze, *target: str) -> None:
    """A refresh that must fail in its last table."""
    from pyspark.errors import PySparkException
    try:
        P.refresh_all(spark, _wrong_unit(bronze), target[0], gold_dir=target[1] if len(target) > 1 else None)
    except PySparkException:
        return
    raise AssertionError("the refresh of rates beyond DECIMAL(10,2) should have failed")


_FIGURES_SQL = with_ctes(_GOLD_BASE, [_STATS_SQL, _PERF_SQL, _DAILY_SQL]).rstrip() + _AFTER_FAILURE_SQL


@register("refresh_failed_keeps_tables", _FIGURES_SQL)
def q_refresh_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh, then one that fails in its last table: version 1 is read, with the rows of before."""
    import uuid

    from quantleaf.session import scratch_path
    b = proxy.load(spark, sf_dir)
    out = scratch_path(spark, f"versions-{uuid.uuid4().hex}")
    P.refresh_all(spark, b, out)
    _failed_refresh(spark, b, out)
    return _figures(versions.current(spark, out))


@register("refresh_failed_keeps_catalog_tables", _FIGURES_SQL)
def q_refresh_failed_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with catalog tables in two databases (their folders in the shared one)."""
    import uuid

    from quantleaf.session import scratch_path
    b = proxy.load(spark, sf_dir)
    key = uuid.uuid4().hex
    names = [f"ql_{layer}_{key}" for layer in ("silver", "gold")]
    for name in names:
        spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    try:
        P.refresh_all(spark, b, names[0], gold_dir=names[1])
        _failed_refresh(spark, b, *names)
        return checkpointed(_figures(versions.current(spark, names[1])))
    finally:
        for name in names:
            spark.sql(f"DROP DATABASE {name} CASCADE")


# Stored bronze has no line numbers: its fetch order is the fetch time, then the quoted values.
_STORED = [BASE_CTES["silver_prices"].replace("'line': l_linenumber, 'part': l_partkey, 'supp': l_suppkey, 'open_price': open_price,", (
    "'close_price': close_price, 'volume': volume, 'open_price': open_price,")).replace("'low_price': low_price, 'close_price': close_price, 'volume': volume,",
                                                                                        "'low_price': low_price,")]


@register("gold_from_stored_bronze", "WITH " + ",\n".join(x.strip() for x in (
    [BASE_CTES["bronze_prices"], BASE_CTES["companies"], BASE_CTES["currency_map"], BASE_CTES["bronze_forex"], BASE_CTES["bronze_fund"], *_STORED,
     BASE_CTES["silver_forex"], BASE_CTES["silver_fund"], BASE_CTES["as_of"], _STATS_SQL, _PERF_SQL])) + "\nSELECT * FROM perf")
def q_gold_from_stored_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze tables as stored Parquet with the declared schemas, seeds as CSV files; M6 from them."""
    import uuid

    from quantleaf.session import scratch_path
    from quantleaf.sources import bronze as stored
    from quantleaf.sources import seeds
    root = scratch_path(spark, f"bronze-{uuid.uuid4().hex}")
    q_ingest_payload(spark, sf_dir).write.parquet(f"{root}/bronze_stock_prices")
    q_ingest_forex_payload(spark, sf_dir).write.parquet(f"{root}/bronze_forex_rates")
    q_ingest_fundamentals_payload(spark, sf_dir).write.parquet(f"{root}/bronze_stock_fundamentals")
    proxy.companies(spark, sf_dir).write.option("header", True).csv(f"{root}/companies")
    seeds.currency_map(spark).write.option("header", True).csv(f"{root}/currency_map")
    b = stored.load(spark, root, companies_csv=f"{root}/companies", currency_map_csv=f"{root}/currency_map")
    return P.stock_performance(P.gold_inputs(P.build_silver(b, EngineConfig(), cut_lineage=True), EngineConfig()))
