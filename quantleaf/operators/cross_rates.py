"""M30, cross rates: every currency of a day in terms of a base, through the pairs quoted that day.

The quotes of a day are a graph: a pair ``A/B`` at rate r leads from A to B at r and from B to A at 1/r. Starting at the base,
each round reaches the currencies that have a quote with one reached before: fewest steps first, then the path that comes first by name. A round
is a join on (day, currency) with one row per day and currency reached, and a grouped minimum; there are as many rounds as the
longest path has steps, at most ``max_steps``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantleaf.functions import exprs as X
from quantleaf.session import checkpointed


def cross_rates(fx: DataFrame, base: str, max_steps: int = 8) -> DataFrame:
    """currency, trade_date, rate (one unit of the currency in units of ``base``), path, steps; currencies without any path are left out.

    ``fx``: currency_pair, trade_date, close_rate, one row per pair and day; quotes that are NULL or not above 0 lead nowhere.
    Of a pair quoted both ways, ``X/base`` order wins as the path does not tell them apart: the direct quote, then the inverted one."""
    pair = F.split("currency_pair", "/")
    quotes = fx.where(F.col("close_rate") > 0).select(
        "trade_date", pair.getItem(0).alias("a"), pair.getItem(1).alias("b"), F.col("close_rate").cast("double").alias("r"))
    edges = (quotes.select("trade_date", F.col("a").alias("currency"), F.col("b").alias("next"), "r", F.lit(0).alias("inverted"))
             .unionByName(quotes.select("trade_date", F.col("b").alias("currency"), F.col("a").alias("next"), (1.0 / F.col("r")).alias("r"),
                                        F.lit(1).alias("inverted")))
             .where("currency <> next"))
    edges = checkpointed(edges.groupBy("trade_date", "currency", "next").agg(F.min(F.struct("inverted", "r")).alias("q"))
                         .select("trade_date", "currency", "next", F.col("q.r").alias("r")))
    reached = edges.select("trade_date").distinct().select(
        "trade_date", F.lit(base).alias("currency"), F.lit(1.0).alias("rate"), F.lit(base).alias("path"), F.lit(0).alias("steps"))
    front = reached
    for step in range(1, max_steps + 1):
        found = edges.join(front.select("trade_date", F.col("currency").alias("next"), "rate", "path"), ["trade_date", "next"])
        found = found.select("trade_date", "currency", F.struct(F.concat_ws("-", "currency", "path").alias("path"), (F.col("r") * F.col("rate")).alias("rate")).alias("way"))
        found = found.join(reached.select("trade_date", "currency"), ["trade_date", "currency"], "left_anti")
        front = checkpointed(found.groupBy("trade_date", "currency").agg(F.min("way").alias("way")).select(
            "trade_date", "currency", "way.rate", "way.path", F.lit(step).alias("steps")))
        if front.isEmpty():
            break
        reached = checkpointed(reached.unionByName(front))
    return reached.where("steps > 0").select("currency", "trade_date", X.to_dec("rate", 18, 6).alias("rate"), "path", "steps")
