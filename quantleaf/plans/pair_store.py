"""Stored pair moments (M11, G8, V7): the exact sums behind the correlations, kept per date chunk.

A version of the folder holds one part per chunk of days: n, Σx, Σy, Σxy, Σx², Σy² of every pair of tickers in it. A new or
corrected day recomputes the chunk it lies in, from that chunk's rows alone; the matrix, ``min_obs`` and the pair count are sums over the
parts, without a product.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantleaf.config import EngineConfig
from quantleaf.operators import correlation as C
from quantleaf.plans import versions

CHUNK = "_chunk"


def chunk_of(day: dt.date, cfg: EngineConfig) -> int:
    return (day - dt.date(1970, 1, 1)).days // cfg.corr_chunk_days


def update(spark: SparkSession, prices: DataFrame, companies: DataFrame, target: str, cfg: EngineConfig,
           changed: Iterable[dt.date] | None = None) -> versions.Version:
    """Publish the moments with the chunks of the ``changed`` days recomputed (None, or nothing stored yet: all chunks).

    A chunk without rows left keeps no part."""
    found = versions.versions(spark, target)
    now = found[max(found)] if found else None
    rows = prices.where(F.col("daily_return_pct").isNotNull()).select("ticker", "trade_date", "daily_return_pct")
    keep: dict[str, str] = {}
    if now is not None and changed is not None:
        chunks = {chunk_of(d, cfg) for d in changed}
        day0 = dt.date(1970, 1, 1)
        spans = [(day0 + dt.timedelta(days=c * cfg.corr_chunk_days), day0 + dt.timedelta(days=(c + 1) * cfg.corr_chunk_days)) for c in sorted(chunks)]
        wanted = F.lit(False)
        for a, b in spans:              # plain date ranges: they reach the scan
            wanted = wanted | ((F.col("trade_date") >= F.lit(a)) & (F.col("trade_date") < F.lit(b)))
        rows = rows.where(wanted)
        keep = {n: p for n, p in now.places.items() if int(n.split("/")[1]) not in chunks}
    blocks = cfg.corr_blocks if cfg.corr_blocks > 0 else C.auto_blocks(companies)
    with versions.building(spark, target) as build:
        if not rows.isEmpty():
            build.write_parts("moments", C.chunk_moments(rows, blocks, cfg.corr_chunk_days).withColumnRenamed("chunk", CHUNK), CHUNK)
        return build.publish(keep=keep)


def moments(version: versions.Version) -> DataFrame:
    """stock_1, stock_2 and the six sums over all parts."""
    fields = "stock_1 string, stock_2 string, " + ", ".join(f"{m} decimal(38,0)" for m in C.MOMENTS)
    places = list(version.places.values())
    parts = version.spark.read.schema(fields).parquet(*places) if places else version.spark.createDataFrame([], fields)
    return parts.groupBy("stock_1", "stock_2").agg(*[F.sum(m).alias(m) for m in C.MOMENTS])


def correlation_matrix(version: versions.Version, companies: DataFrame, cfg: EngineConfig) -> DataFrame:
    """M11 from the stored sums."""
    return C.matrix_of(moments(version), companies, cfg)


def pair_count(version: versions.Version, prices: DataFrame) -> DataFrame:
    """V7 from the stored sums: pairs against n(n−1)/2 of the tickers with returns."""
    from quantleaf.operators import quality as Q
    return Q.pair_count_check(moments(version).select("stock_1", "stock_2"), prices)
