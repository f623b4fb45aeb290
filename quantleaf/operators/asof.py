"""General backward as-of join (J8, J14): for each left row the last right row of its key at or before its date.

Both sides are put below each other and windowed by (key, time bucket): within a bucket the last right row before a left row is
a running value; what a bucket needs from before its start comes as one carry row, taken from the last earlier bucket of the
key that has a right row. So no grid of days is built, both sides are read once, and a key's history is spread over its buckets. A key
that holds many left rows per bucket is split further by ``salts``: its left rows are dealt by hash, and the right rows, which are
few, are repeated for each salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantleaf.operators.windows import time_bucket

_BUCKET, _SALT, _RIGHT, _LEFT, _DATE = "_bucket", "_salt", "_right", "_left", "_date"


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], date_col: str, values: list[str], bucket_days: int = 90,
              tolerance_days: int | None = None, quote_date: str | None = None, salts: int = 1) -> DataFrame:
    """``left`` with ``values`` of the last row of ``right`` with the same ``keys`` and a date at or before the left row's.

    ``right`` has one row per key and date. A left row without such a row, with a NULL key or date, or whose right row is older than
    ``tolerance_days``, gets NULLs. ``quote_date`` names a column for the right row's date. Every left row stays, repeated ones too."""
    mark = F.struct(F.col(date_col).alias("d"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    matchable = F.col(date_col).isNotNull()
    for k in keys:
        matchable = matchable & F.col(k).isNotNull()
    known = right.where(matchable).select(*keys, F.col(date_col).alias(_DATE), time_bucket(date_col, bucket_days).alias(_BUCKET), mark.alias(_RIGHT))
    rows = left.select(
        *keys, F.col(date_col).alias(_DATE), time_bucket(date_col, bucket_days).alias(_BUCKET),
        F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int").alias(_SALT), F.struct(*left.columns).alias(_LEFT))

    # The last right row of each (key, bucket), and where it is needed: carried to every bucket until the next right row.
    tails = right.where(matchable).groupBy(*keys, time_bucket(date_col, bucket_days).alias(_BUCKET)).agg(
        F.max(date_col).alias("d"), *[F.max_by(c, F.col(date_col)).alias(f"v{i}") for i, c in enumerate(values)])
    tails = tails.select(*keys, _BUCKET, F.struct("d", *[f"v{i}" for i in range(len(values))]).alias(_RIGHT))
    spots = rows.select(*keys, _BUCKET).where(F.col(_BUCKET).isNotNull()).distinct().withColumn(_RIGHT, F.lit(None).cast(tails.schema[_RIGHT].dataType))
    by_key = Window.partitionBy(*keys).orderBy(_BUCKET)
    merged = tails.unionByName(spots).groupBy(*keys, _BUCKET).agg(F.max(_RIGHT).alias(_RIGHT), F.max(F.col(_RIGHT).isNull()).alias("_wanted"))
    before = F.last(_RIGHT, ignorenulls=True).over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    carry = (merged.select(*keys, _BUCKET, before.alias(_RIGHT), "_wanted").where(F.col("_wanted") & F.col(_RIGHT).isNotNull())
             .select(*keys, F.lit(None).cast("date").alias(_DATE), _BUCKET, _RIGHT))

    marks = known.unionByName(carry).withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    both = marks.unionByName(rows, allowMissingColumns=True)
    # Carry rows come first (no date), then by date, right rows before left ones.
    w = (Window.partitionBy(*keys, _BUCKET, _SALT).orderBy(F.col(_DATE).asc_nulls_first(), F.col(_LEFT).isNotNull())
         .rowsBetween(Window.unboundedPreceding, 0))
    out = both.withColumn("_found", F.last(_RIGHT, ignorenulls=True).over(w)).where(F.col(_LEFT).isNotNull())
    found = F.col("_found")
    if tolerance_days is not None:
        found = F.when(F.datediff(F.col(_DATE), found["d"]) <= tolerance_days, found)
    return out.select(f"{_LEFT}.*", *[found[f"v{i}"].alias(c) for i, c in enumerate(values)],
                      *([found["d"].alias(quote_date)] if quote_date else []))
