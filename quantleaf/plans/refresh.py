"""The refresh (bronze → silver → gold) as lazy DataFrame plans.

``build_silver`` / ``build_gold`` return DataFrames; ``refresh_*`` write them aside
and publish all of them as one version (``plans.versions``): a step that fails, in
its first task or its last, leaves the published tables as they were and
raises. Gold steps that re-read a silver table read it back from its written
location, which also cuts the lineage between the layers.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import logging
import os
import threading
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantleaf import schemas
from quantleaf.config import EngineConfig
from quantleaf.operators import gold as G
from quantleaf.operators import silver as S
from quantleaf.operators.gates import SILVER_GATES
from quantleaf.plans import versions
from quantleaf.session import checkpointed
from quantleaf.sources.proxy import Bronze


log = logging.getLogger("quantleaf.refresh")


@dataclass
class Silver:
    prices: DataFrame
    fundamentals: DataFrame
    forex: DataFrame
    companies: DataFrame
    currency_map: DataFrame


@dataclass
class GoldInputs:
    silver: Silver
    as_of: dt.date
    cfg: EngineConfig
    stats: DataFrame
    fx: DataFrame


def build_silver_table(name: str, bronze: Bronze, cfg: EngineConfig, cut_lineage: bool = False) -> DataFrame:
    digits = getattr(bronze, "order_digits", {})        # bronze without them is deduplicated by sorting
    if name == "silver_stock_prices":
        return S.clean_prices(bronze.prices, bronze.price_order, cfg.minor_units, cfg.bucket_days, cut_lineage,
                              cfg.minor_units_by_ticker, digits.get("prices"))
    if name == "silver_stock_fundamentals":
        return S.clean_fundamentals(bronze.fundamentals, bronze.fund_order, digits.get("fundamentals"))
    if name == "silver_forex_rates":
        return S.clean_forex(bronze.forex, bronze.fx_order, cfg.bucket_days, cut_lineage, digits.get("forex"))
    return {"silver_companies": bronze.companies, "silver_currency_map": bronze.currency_map}[name]


def build_silver(bronze: Bronze, cfg: EngineConfig, cut_lineage: bool = False) -> Silver:
    return Silver(*[build_silver_table(n, bronze, cfg, cut_lineage) for n in SILVER_TABLES])


SILVER_TABLES = ["silver_stock_prices", "silver_stock_fundamentals", "silver_forex_rates",
                 "silver_companies", "silver_currency_map"]
# Row order inside each written file: key then date, so Parquet row-group min/max
# statistics let ticker / pair and date-range filters (dashboard slicers) skip data.
_FILE_ORDER = {"silver_stock_prices": ["ticker", "trade_date"],
               "silver_forex_rates": ["currency_pair", "trade_date"]}


def _laid_out(name: str, df: DataFrame) -> DataFrame:
    cols = _FILE_ORDER.get(name)
    return df.sortWithinPartitions(*cols) if cols else df
# Raise when the meaning of a stored silver table changes: older builds are then not read.
SILVER_VERSION = 4
_AS_OF: dict[str, dt.date] = {}


def _file_states(spark: SparkSession, path: str) -> list[str] | None:
    """Path, size and time of every file below ``path`` on any Hadoop file system; None if it can't be told."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
        out = []
        while found.hasNext():
            f = found.next()
            out.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
        return sorted(out)
    except Exception:       # no such path, no Hadoop access (Spark Connect): the build is not reused
        return None


def _exists(spark: SparkSession, path: str) -> bool:
    return bool(_file_states(spark, path))


def _fingerprint(spark: SparkSession, inputs: list[str], cfg: EngineConfig) -> str | None:
    """Identity of a silver build: the inputs' files, the version of the cleaning code, the config; None: unknown."""
    h = hashlib.sha256(repr((SILVER_VERSION, sorted(cfg.minor_units.items()), sorted((cfg.minor_units_by_ticker or {}).items()),
                             cfg.bucket_days)).encode())
    for p in sorted(inputs):
        states = _file_states(spark, p)
        if not states:
            return None
        h.update("\n".join(states).encode())
    return h.hexdigest()[:20]


_SILVER_LOCK = threading.RLock()
_READ: dict[tuple[str, str], dict[str, DataFrame]] = {}


class StoredSilver:
    """Silver tables, each written on first use, once per input fingerprint, under ``root`` (a shared folder) and read
    back: gold queries start from the written tables (as the reference's gold layer reads its silver tables), the lineage to
    bronze is cut, and a query that needs FX alone does not deduplicate prices.

    A table counts as written only when its ``_SUCCESS`` marker exists, so an interrupted build is redone, never half-read.
    """

    def __init__(self, spark: SparkSession, bronze: Bronze, cfg: EngineConfig, root: str, inputs: list[str]):
        self.spark, self.bronze, self.cfg = spark, bronze, cfg
        # Inputs that can't be identified get a build of their own, used by this object only.
        self.base = os.path.join(root, "silver-" + (_fingerprint(spark, inputs, cfg) or uuid.uuid4().hex))
        # Read once per session and build: a build never changes, and opening its tables is a job each.
        self._read: dict[str, DataFrame] = _READ.setdefault((spark.sparkContext.applicationId, self.base), {})

    def _table(self, name: str) -> DataFrame:
        with _SILVER_LOCK:   # concurrent queries in one driver build a missing table once
            if name not in self._read:
                path = os.path.join(self.base, name)
                if not _exists(self.spark, os.path.join(path, "_SUCCESS")):
                    df = build_silver_table(name, self.bronze, self.cfg, cut_lineage=True)
                    _laid_out(name, df).write.mode("overwrite").parquet(path)
                self._read[name] = self.spark.read.schema(schemas.SILVER[name]).parquet(path)
            return self._read[name]

    prices = property(lambda self: self._table("silver_stock_prices"))
    fundamentals = property(lambda self: self._table("silver_stock_fundamentals"))
    forex = property(lambda self: self._table("silver_forex_rates"))
    companies = property(lambda self: self._table("silver_companies"))
    currency_map = property(lambda self: self._table("silver_currency_map"))

    @property
    def as_of(self) -> dt.date:
        """The configured reporting date, else the last trade date of this build."""
        if self.cfg.as_of is not None:
            return self.cfg.as_of
        if self.base not in _AS_OF:
            _AS_OF[self.base] = self.prices.agg(F.max("trade_date")).first()[0]
        return _AS_OF[self.base]

    def tables(self) -> Silver:
        """All tables, built where missing."""
        return Silver(*[self._table(n) for n in SILVER_TABLES])


def gold_inputs(silver: Silver, cfg: EngineConfig) -> GoldInputs:
    as_of = G.resolve_as_of(silver.prices, cfg)
    cfg = cfg.with_as_of(as_of)
    return GoldInputs(silver, as_of, cfg,
                      stats=G.ticker_stats(silver.prices, as_of, cfg),
                      fx=G.fx_stats(silver.forex, as_of, cfg))


def stock_performance(g: GoldInputs) -> DataFrame:
    return G.stock_performance(g.stats, g.silver.companies, g.silver.fundamentals, g.cfg)


def _universe(g: GoldInputs) -> DataFrame | None:
    """sp: later gold steps inner-join the written gold_stock_performance."""
    return stock_performance(g) if g.cfg.sp else None


def currency_adjusted(g: GoldInputs) -> DataFrame:
    dense = G.densify_fx(g.silver.forex, g.as_of, g.cfg.bucket_days) if g.cfg.align_fx else None
    return G.currency_adjusted_returns(g.stats, g.fx, g.silver.companies, g.silver.currency_map, g.cfg, dense,
                                       _universe(g))


def dividend(g: GoldInputs) -> DataFrame:
    return G.dividend_analysis(g.stats, g.silver.fundamentals, g.fx, g.silver.companies, g.silver.currency_map,
                               g.cfg, _universe(g))


def daily_inr(g: GoldInputs) -> DataFrame:
    return G.daily_inr_returns(g.silver.prices, g.silver.forex, g.silver.companies,
                               g.silver.currency_map, g.cfg)


def correlation(g: GoldInputs) -> DataFrame:
    from quantleaf.operators.correlation import correlation_matrix
    return correlation_matrix(g.silver.prices, g.silver.companies, g.cfg)


def build_gold(silver: Silver, cfg: EngineConfig) -> dict[str, DataFrame]:
    g = gold_inputs(silver, cfg)
    perf = stock_performance(g)
    cur = currency_adjusted(g)
    return {
        "gold_stock_performance": perf,
        "gold_currency_adjusted_returns": cur,
        "gold_category_performance": G.category_performance(perf, g.cfg),
        "gold_region_performance": G.region_performance(perf, cur, g.cfg),
        "gold_dividend_analysis": dividend(g),
        "gold_correlation_matrix": correlation(g),
        "gold_daily_inr_returns": daily_inr(g),
    }


def _write_silver(build: versions.Build, bronze: Bronze, cfg: EngineConfig, target: str | None = None) -> Silver:
    """Write the silver tables, behind their gates, and the calendar into ``build``; returns them read back from storage."""
    s = build_silver(bronze, cfg, cut_lineage=True)
    r = {name: build.write_gated(name, _laid_out(name, df), SILVER_GATES[name], target)
         for name, df in zip(SILVER_TABLES, (s.prices, s.fundamentals, s.forex, s.companies, s.currency_map), strict=True)}
    # M4: the date dimension for BI time filters, spanning the written price history
    build.write("silver_calendar", S.calendar_for(r["silver_stock_prices"]), target)
    return Silver(*[r[n] for n in SILVER_TABLES])


def _write_gold(build: versions.Build, silver: Silver, cfg: EngineConfig, target: str | None = None) -> list[str]:
    """Write the gold tables into ``build`` in dependency order; returns their names.

    The per-ticker and per-pair aggregates (one row per ticker / pair) are
    checkpointed once, so M6, M7 and M10 share one scan of the silver prices.
    """
    g = gold_inputs(silver, cfg)
    g.stats, g.fx = checkpointed(g.stats), checkpointed(g.fx)
    names = []

    def put(name: str, df: DataFrame) -> DataFrame:
        names.append(name)
        return build.write(name, df, target)     # a failure raises here; nothing is published

    perf = put("gold_stock_performance", stock_performance(g))
    cur = put("gold_currency_adjusted_returns", currency_adjusted(g))
    put("gold_category_performance", G.category_performance(perf, g.cfg))
    put("gold_region_performance", G.region_performance(perf, cur, g.cfg))
    put("gold_dividend_analysis", dividend(g))
    put("gold_correlation_matrix", correlation(g))
    put("gold_daily_inr_returns", daily_inr(g))
    return names


def refresh_silver(spark: SparkSession, bronze: Bronze, out: str, cfg: EngineConfig) -> Silver:
    """Publish the silver tables as a version of ``out`` (a folder or a database); returns them read back."""
    with versions.building(spark, out, schemas.check_contract) as build:
        silver = _write_silver(build, bronze, cfg)
        build.publish()
        return silver


def refresh_gold(spark: SparkSession, silver: Silver, out: str, cfg: EngineConfig) -> dict[str, str]:
    """Publish the gold tables as a version of ``out``; returns name → place."""
    with versions.building(spark, out, schemas.check_contract) as build:
        _write_gold(build, silver, cfg)
        return build.publish().places


def refresh_all(spark: SparkSession, bronze: Bronze, out: str, cfg: EngineConfig | None = None,
                gold_dir: str | None = None) -> dict[str, str]:
    """Silver then gold, published together: readers of ``versions.current(spark, out)`` see one version of all tables.

    ``out`` is a folder or a database. With ``gold_dir``, a second database: the gold tables are written there, its version holds
    all tables, and ``out`` gets a version of the silver ones. Returns name → place of the gold tables."""
    cfg = cfg or EngineConfig()
    with versions.building(spark, gold_dir or out, schemas.check_contract) as build:
        silver = _write_silver(build, bronze, cfg, out)
        silver_names = build.names()
        gold_names = _write_gold(build, silver, cfg)
        version = build.publish()
        if gold_dir:
            build.publish(out, silver_names)
    return {n: version.places[n] for n in gold_names}


def main(argv: list[str] | None = None) -> None:
    """Nightly refresh (E1): ``python -m quantleaf.plans.refresh --sf-dir DIR --out DIR``
    for the proxy inputs, or ``--bronze DIR`` for bronze tables with the declared schemas."""
    import argparse
    import datetime as _dt

    from quantleaf.session import get_spark
    ap = argparse.ArgumentParser(description=main.__doc__)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="folder with the generated test tables (proxy bronze)")
    src.add_argument("--bronze", help="folder with bronze_stock_prices / _fundamentals / bronze_forex_rates")
    ap.add_argument("--out", required=True, help="output folder; plans.versions.current() reads its latest version")
    ap.add_argument("--as-of", help="reporting date YYYY-MM-DD (default: last trade date)")
    ap.add_argument("--variant", default="dbt", choices=["dbt", "sp"])
    a = ap.parse_args(argv)
    spark = get_spark(app="quantleaf-refresh")
    if a.sf_dir:
        from quantleaf.sources import proxy
        bronze = proxy.load(spark, a.sf_dir)
    else:
        from quantleaf.sources import bronze as bronze_tables
        bronze = bronze_tables.load(spark, a.bronze)
    cfg = EngineConfig(as_of=_dt.date.fromisoformat(a.as_of) if a.as_of else None, reference_variant=a.variant)
    for name, path in refresh_all(spark, bronze, a.out, cfg).items():
        print(name, path)


if __name__ == "__main__":
    main()
