"""Ranking without funnelling a table (or one hot group) through a single task.

``rank_by`` gives SQL ``RANK()`` semantics (ties share a rank, the next rank
skips) over an optional partition, NULL values unranked:

1. rows collapse to distinct (partition, value) with their multiplicity — a
   partial aggregate, so a value shared by a third of the rows becomes one row;
2. the ordering key is cut into buckets by approximate quantiles of the
   distinct values (a bounded list of boundaries);
3. rank = 1 + rows in earlier buckets of the same partition (a window over at
   most ``buckets`` rows per partition) + rows earlier in the own bucket (a
   window over one bucket's distinct values);
4. the ranks join back to the rows on (partition, value).

``top_by`` keeps the rows that tie for the best value of each group (TOPN(1)
with ties) with an aggregate and an equi-join instead of a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_by(df: DataFrame, value: str, partition: list[str] | None = None,
            descending: bool = True, out: str = "rank", buckets: int = 64) -> DataFrame:
    part = list(partition or [])
    v = F.col(value)
    key = -v if descending else v
    distinct = (df.where(v.isNotNull()).groupBy(*part, value).agg(F.count(F.lit(1)).alias("_c"))
                .withColumn("_k", key))
    probs = [i / buckets for i in range(1, buckets)]
    bounds = distinct.agg(F.percentile_approx("_k", probs, 10000).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    if bounds:
        arr = F.array(*[F.lit(b) for b in bounds])
        bucket = F.size(F.filter(arr, lambda b: b < F.col("_k")))
    else:
        bucket = F.lit(0)
    d = distinct.withColumn("_b", bucket)
    totals = d.groupBy(*part, "_b").agg(F.sum("_c").alias("_bc"))
    before_bucket = Window.partitionBy(*part).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, "_b", F.coalesce(F.sum("_bc").over(before_bucket), F.lit(0)).alias("_off"))
    in_bucket = Window.partitionBy(*part, "_b").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (d.select(*part, value, "_b", F.coalesce(F.sum("_c").over(in_bucket), F.lit(0)).alias("_before"))
              .join(offsets, [*part, "_b"], "inner")
              .select(*part, value, (F.col("_off") + F.col("_before") + 1).cast("int").alias(out)))
    # Rows without a value have no rank; kept out of the join, where they would all meet in one partition.
    unranked = df.where(v.isNull()).withColumn(out, F.lit(None).cast("int"))
    return df.where(v.isNotNull()).join(ranked, [*part, value], "left").select(*df.columns, out).unionByName(unranked)


def top_by(df: DataFrame, value: str, partition: list[str], descending: bool = True) -> DataFrame:
    """Rows holding the best non-NULL ``value`` of their partition (ties kept)."""
    agg = F.max(value) if descending else F.min(value)
    best = df.groupBy(*partition).agg(agg.alias("_best"))
    return (df.join(best, partition, "inner")
            .where(F.col(value) == F.col("_best")).drop("_best"))
