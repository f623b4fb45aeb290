"""Silver prices kept up to date feed by feed (ST1, §2.10): a late or corrected fetch changes its own time buckets and the
first row after each, and nothing else is read or written.

A version (``plans.versions``) of the folder holds, per time bucket, the state (latest fetch per ticker and day, with its place
in the fetch order) and the silver rows, and one small table of tails: the last close of each (ticker, bucket). A feed

1. merges with the state of the buckets it touches,
2. gives the new tails of these buckets; where the tail of a ticker has changed, its next bucket has another row before its first,
3. recomputes the returns of the touched and the following buckets, with the tails as the rows before,
4. publishes the new parts together with the old parts of all other buckets, as one version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantleaf import schemas
from quantleaf.config import EngineConfig
from quantleaf.operators import silver as S
from quantleaf.operators.windows import bucket_tails, latest_by_key, pack_order, time_bucket
from quantleaf.plans import versions
from quantleaf.session import checkpointed

BUCKET = "_part"
_TAIL = ["ticker", "_bkt", "trade_date", "close_price"]


def _parts(version: versions.Version | None, prefix: str, buckets: set[int] | None = None) -> list[str]:
    if version is None:
        return []
    found = {int(n.split("/")[1]): p for n, p in version.places.items() if n.startswith(prefix + "/")}
    return [p for b, p in sorted(found.items()) if buckets is None or b in buckets]


def silver_prices(version: versions.Version) -> DataFrame:
    """The silver price table of a version."""
    return version.spark.read.schema(schemas.SILVER["silver_stock_prices"]).parquet(*_parts(version, "silver"))


def _buckets(df: DataFrame, column: str) -> set[int]:
    """Distinct time buckets: bounded by the calendar (4 a year at 90 days), not by the rows."""
    return {r[0] for r in df.select(column).distinct().collect()}


def apply_feed(spark: SparkSession, feed: DataFrame, target: str, cfg: EngineConfig, order_cols: list[str], digits: list[int]) -> versions.Version:
    """Publish the silver prices with ``feed`` (bronze rows: new, late or corrected fetches) taken in; a re-sent feed changes nothing."""
    found = versions.versions(spark, target)
    now = found[max(found)] if found else None
    rows = S.with_unit(feed.withColumn("trade_date", F.col("trade_date").cast("date")), cfg.minor_units, cfg.minor_units_by_ticker)
    rows = rows.select("ticker", "trade_date", pack_order(rows, order_cols, digits).alias("_order"), *S.PRICE_PAYLOAD)
    rows = checkpointed(rows.withColumn(BUCKET, time_bucket("trade_date", cfg.bucket_days)))
    touched = _buckets(rows, BUCKET)
    if not touched:
        return now if now is not None else _publish_empty(spark, target, rows, cfg)

    with versions.building(spark, target) as build:
        old = _parts(now, "state", touched)
        state = rows.drop(BUCKET)
        if old:
            state = spark.read.schema(state.schema).parquet(*old).unionByName(state)
        merged = latest_by_key(state, ["ticker", "trade_date"], ["_order"], ["_order", *S.PRICE_PAYLOAD], [37])
        build.write_parts("state", merged.withColumn(BUCKET, time_bucket("trade_date", cfg.bucket_days)), BUCKET)

        fresh = spark.read.schema(state.schema).parquet(*[build.places[f"state/{b}"] for b in sorted(touched)])
        tails = bucket_tails(S.converted(fresh), ["ticker"], "trade_date", ["close_price"], cfg.bucket_days).select(*_TAIL)
        before = now.table("tails") if now is not None else tails.limit(0)
        tails = build.write("tails", before.where(~F.col("_bkt").isin(*touched)).unionByName(tails))
        following = touched | _buckets(_after_changed(before, tails, touched), "_next")

        kept = _parts(now, "state", following - touched)
        of_following = spark.read.schema(state.schema).parquet(*kept, *[build.places[f"state/{b}"] for b in sorted(touched)])
        silver = S.price_returns(S.converted(of_following), cfg.bucket_days, tails)
        build.write_parts("silver", silver.withColumn(BUCKET, time_bucket("trade_date", cfg.bucket_days)).sortWithinPartitions(
            BUCKET, "ticker", "trade_date"), BUCKET)
        return build.publish(keep=now.places if now is not None else None)


def _after_changed(before: DataFrame, tails: DataFrame, touched: set[int]) -> DataFrame:
    """``_next``: the bucket after a touched one, for tickers whose tail there is new or has another close or day."""
    old = before.where(F.col("_bkt").isin(*touched)).select("ticker", "_bkt", F.struct("trade_date", "close_price").alias("_was"))
    later = F.lead("_bkt").over(Window.partitionBy("ticker").orderBy("_bkt"))       # a ticker's buckets: 4 rows a year
    moved = tails.withColumn("_next", later).where(F.col("_bkt").isin(*touched)).join(old, ["ticker", "_bkt"], "left")
    return moved.where(F.col("_next").isNotNull() & ~F.struct("trade_date", "close_price").eqNullSafe(F.col("_was"))).select("_next")


def _publish_empty(spark: SparkSession, target: str, rows: DataFrame, cfg: EngineConfig) -> versions.Version:
    with versions.building(spark, target) as build:
        build.write("tails", bucket_tails(S.converted(rows), ["ticker"], "trade_date", ["close_price"], cfg.bucket_days).select(*_TAIL))
        return build.publish()
