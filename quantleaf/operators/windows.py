"""Keyed, ordered primitives that stay balanced when one key is huge.

* ``latest_by_key`` — latest fetch per key (W1–W3) as one aggregate with a
  map-side partial step: however many copies a hot key has, each map task
  sends at most one row per key to the shuffle.
* ``segmented_lag`` / ``segmented_ffill`` — LAG and forward fill per key
  ordered by date (W7–W9). A plain ``Window.partitionBy(key)`` puts a whole key
  into one task; here rows are windowed by (key, time bucket) and each bucket
  receives one *carry row* holding the state at the end of the previous
  non-empty bucket, computed from a small per-(key, bucket) aggregate. One
  shuffle of the detail rows, no join, exact results.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BKT, _CARRY = "_bkt", "_carry"
_FIXED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def pack_order(df: DataFrame, order_cols: list[str], digits: list[int]) -> Column:
    """One DECIMAL(38,0) that orders rows as the tuple of ``order_cols`` does (whole numbers of 0 or more, with at most
    ``digits`` digits each; a NULL comes first). A value that does not fit raises: rows are never ordered wrongly."""
    if sum(digits) > 37:
        raise ValueError(f"an order of {sum(digits)} digits does not fit one decimal")
    packed = None
    for c, n in zip(order_cols, digits, strict=True):
        value = F.col(c).cast("decimal(38,0)")
        v = (F.when(value.isNull(), 0).when(value.between(0, F.lit(Decimal(10 ** n - 2))), value + 1)
             .otherwise(F.raise_error(F.concat(F.lit(f"{c} does not fit {n} digits: "), F.col(c).cast("string"))).cast("decimal(38,0)")))
        packed = v if packed is None else packed * F.lit(Decimal(10) ** n) + v
    return packed.cast("decimal(38,0)")


def latest_by_key(df: DataFrame, keys: list[str], order_cols: list[str],
                  payload: list[str], digits: list[int] | None = None) -> DataFrame:
    """One row per key: the row with the largest ``order_cols`` tuple.

    With ``digits`` of the order columns (``pack_order``) and a payload of fixed width, each column is picked by itself in
    fixed-width buffers: hash aggregates on both sides of the shuffle, no sort. Rows that are equal in the whole order
    are picked alike for every column. Otherwise the rows are compared as structs, which Spark aggregates by sorting."""
    if digits and all(isinstance(df.schema[c].dataType, _FIXED) for c in payload):
        ordered = df.withColumn("_order", pack_order(df, order_cols, digits))
        return ordered.groupBy(*keys).agg(*[F.max_by(c, "_order").alias(c) for c in payload])
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*payload), F.struct(*order_cols)).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in payload]))


def time_bucket(date_col: str, bucket_days: int) -> Column:
    return F.floor(F.unix_date(F.col(date_col)) / bucket_days)


def _carry_rows(tails: DataFrame, keys: list[str], order_col: str, cols: list[str]) -> DataFrame:
    """Move each bucket's end state to the key's next non-empty bucket."""
    nxt = F.lead(_BKT).over(Window.partitionBy(*keys).orderBy(_BKT))
    return (tails.withColumn("_next", nxt)
            .where(F.col("_next").isNotNull())
            .select(*keys, F.col("_next").alias(_BKT), F.col(order_col),
                    *[F.col(c) for c in cols], F.lit(True).alias(_CARRY)))


def bucket_tails(df: DataFrame, keys: list[str], order_col: str, value_cols: list[str], bucket_days: int) -> DataFrame:
    """The last row of each (key, bucket): what the next bucket of the key needs."""
    # order_col is unique within a key, so per-column max_by picks one consistent row;
    # fixed-width values keep this a hash aggregate.
    return df.withColumn(_BKT, time_bucket(order_col, bucket_days)).groupBy(*keys, _BKT).agg(
        F.max(order_col).alias(order_col),
        *[F.max_by(c, F.col(order_col)).alias(c) for c in value_cols])


def segmented_lag(df: DataFrame, keys: list[str], order_col: str, value_cols: list[str],
                  bucket_days: int, prefix: str = "prev_", tails: DataFrame | None = None) -> DataFrame:
    """Add ``prefix + c`` = LAG(c) over (PARTITION BY keys ORDER BY order_col) for each c.

    ``order_col`` must be unique within a key (true after dedupe). ``tails``: the end states (``bucket_tails``) of all
    buckets, where ``df`` holds some of them only.
    """
    base = df.withColumn(_BKT, time_bucket(order_col, bucket_days))
    if tails is None:
        tails = bucket_tails(df, keys, order_col, value_cols, bucket_days)
    carry = _carry_rows(tails, keys, order_col, value_cols)
    rows = base.withColumn(_CARRY, F.lit(False))
    u = rows.unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(*keys, _BKT).orderBy(order_col)
    u = u.select("*", *[F.lag(c).over(w).alias(prefix + c) for c in value_cols])
    return u.where(~F.col(_CARRY)).drop(_BKT, _CARRY)


def segmented_ffill(df: DataFrame, keys: list[str], order_col: str, value_cols: list[str],
                    bucket_days: int, flag_col: str | None = "is_valid") -> DataFrame:
    """Replace NULLs in ``value_cols`` by the key's last non-NULL value.

    With ``flag_col`` set, rows where any value was imputed get ``flag_col`` = false.
    """
    base = df.withColumn(_BKT, time_bucket(order_col, bucket_days))
    last_nn = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order_col))).alias(c)
               for c in value_cols]
    tails = base.groupBy(*keys, _BKT).agg(F.max(order_col).alias(order_col), *last_nn)
    # Running last non-null across buckets: the state at the end of each bucket.
    run = Window.partitionBy(*keys).orderBy(_BKT).rowsBetween(Window.unboundedPreceding, 0)
    tails = tails.select(*keys, _BKT, order_col,
                         *[F.last(c, ignorenulls=True).over(run).alias(c) for c in value_cols])
    carry = _carry_rows(tails, keys, order_col, value_cols)
    rows = base.withColumn(_CARRY, F.lit(False))
    u = rows.unionByName(carry, allowMissingColumns=True)
    w = (Window.partitionBy(*keys, _BKT).orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, 0))
    filled = [F.last(c, ignorenulls=True).over(w).alias(f"_f_{c}") for c in value_cols]
    u = u.select("*", *filled)
    imputed = None
    for c in value_cols:
        cond = F.col(c).isNull() & F.col(f"_f_{c}").isNotNull()
        imputed = cond if imputed is None else (imputed | cond)
    out = u.where(~F.col(_CARRY))
    if flag_col:
        prior = F.col(flag_col) if flag_col in df.columns else F.lit(True)
        out = out.withColumn(flag_col, prior & ~imputed)
    for c in value_cols:
        out = out.withColumn(c, F.col(f"_f_{c}")).drop(f"_f_{c}")
    return out.drop(_BKT, _CARRY)
