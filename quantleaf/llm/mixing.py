"""Mixing sources to target weights: Efraimidis-Spirakis sampling, in DataFrame functions only.

Each source gets a target of words: its weight's share of all words, at most ``max_epochs`` times
its own size, with the excess shared out again by weight (water filling). Whole epochs of the source
come first; the rest of the target is filled by documents in the order of exponential keys
-ln(u) / q, where u is a hash of the id and q the document's quality weight (a weighted sample
without replacement). The last document is taken if that brings the source nearer to its target.

Only ids and sizes move. They are stored once; sizes are summed by ranges of the key (up to ``MAX_RANGES`` of a source), and the
prefix sums of these tell the one range in which the target is reached. The rows of that range, equal ones as one, are
sorted and summed, which gives each source a cut in the order of (key, id, size): rows before it are taken, as a row that is not
taken is followed by no row that is. So a document's copies follow from the document and its source's row alone. That table, a row
a source, is stored, and the planner sees its size. Windows without a partition run over the table of sources only.

Defined results: a null text has size 0; a null source is a source of its own, last in order; size-0
documents are never taken, and a source of size 0 has target 0. Rows with equal id, size and key
are alike; where the cut falls among them, the first by a hash of the text are taken (these rows meet in one task). Null ids share
one hash and follow in order of size. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .line_rules import count_of, word_count

MAX_EPOCHS = 3
RANGE_ROWS = 256      # rows a key range should have
MAX_RANGES = 4096     # ranges of one source at most: bounds the table of range sums


def quality_weight(size: Column, symbols: Column) -> Column:
    """Between 0.05 and 1: falls with the symbols per word."""
    return F.greatest(F.lit(0.05), 1.0 - 2.0 * symbols / F.greatest(size, F.lit(1).cast("long")))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, size) rows to one row per source: source_size, n_docs, weight, target."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    s = by_source.withColumn("weight", weight).withColumn("cap", max_epochs * F.col("source_size"))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight").cast("double"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    # The level at which this source's remaining weight would be filled, if all before it are at their caps.
    left = F.sum("source_size").over(every) - (F.sum("cap").over(upto) - F.col("cap"))
    weight_left = F.sum("weight").over(every) - F.sum("weight").over(upto) + F.col("weight")
    s = s.withColumn("level", left / weight_left.cast("double"))
    level = F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(every)
    target = F.when(F.col("ratio") <= F.col("level"), F.col("cap").cast("double")).otherwise(level * F.col("weight"))
    return s.select("source", "source_size", "n_docs", "weight", target.alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS, keep: list[str] | None = None) -> DataFrame:
    """Adds to each document: size, source_size, target, copies, taken (= copies * size).

    ``keep``: further columns of ``docs`` to carry along (none by default), under their own names.
    """
    measured = [F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                count_of(F.col(text_col), r"#*$%&|<>").alias("symbols"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash")]
    sizes = materialise(docs.select(*measured), "mix-sizes")
    sources = source_plan(sizes, weights, max_epochs)
    rows = docs.select(*measured, F.struct(*[F.col(c) for c in keep]).alias("kept_columns")) if keep else sizes
    rows = _placed(rows, sources)
    place = F.struct("key", "doc_id", "size")
    at_cut = (F.col("range") == F.col("edge")) & place.eqNullSafe(F.col("cut"))
    extra = (F.when(F.col("size") == 0, 0).when(F.col("edge").isNull() | (F.col("range") < F.col("edge")), 1)
              .when(at_cut, F.when(F.col("place") <= F.col("cut_taken"), 1).otherwise(0))
              .when((F.col("range") == F.col("edge")) & (place < F.col("cut")), 1).otherwise(0))
    rows = rows.withColumn("place", F.lit(1))
    if not sources.where("cut_taken < cut_rows").isEmpty():     # the cut falls among equal rows
        divided = at_cut & (F.col("cut_taken") < F.col("cut_rows"))
        order = Window.partitionBy("source").orderBy("text_hash")
        rows = (rows.where(~F.coalesce(divided, F.lit(False)))
                .unionByName(rows.where(divided).withColumn("place", F.row_number().over(order))))
    copies = F.when(F.col("size") > 0, F.col("epochs") + extra).otherwise(0).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                       (copies * F.col("size")).alias("taken"), *(["kept_columns"] if keep else []))


def _of_source(rows: DataFrame, small: DataFrame, how: str = "left") -> DataFrame:
    """``rows`` with the columns of ``small``, a table with a row a source (null is one)."""
    small = small.withColumnRenamed("source", "of_source")
    return rows.join(small, F.col("source").eqNullSafe(F.col("of_source")), how).drop("of_source")


def _placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Each row with its source's columns, its key, and the range of the key."""
    u = (F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10)
         .cast("long") + 0.5) / float(1 << 52)
    key = -F.ln(u) / quality_weight(F.col("size"), F.col("symbols"))
    return (_of_source(rows, sources).withColumn("key", key)
            .withColumn("range", F.least(F.col("ranges") - 1, F.floor(F.col("key") / (1 + F.col("key")) * F.col("ranges")).cast("int"))))


def source_plan(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """A row per source of ``sizes`` (doc_id, source, size, symbols): source_size, target, whole ``epochs``, ``rest``, ``ranges`` of
    the key, the range ``edge`` in which the rest is reached (null: it takes all), and there the last taken place ``cut``
    (null: none) with ``cut_taken`` of the ``cut_rows`` rows on it."""
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    ranges = F.greatest(F.lit(1), F.least(F.lit(MAX_RANGES), F.ceil(F.col("n_docs") / RANGE_ROWS)).cast("int"))
    targets = source_targets(sizes.select("source", "size"), weights, max_epochs)
    targets = targets.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    targets = materialise(targets.withColumn("ranges", ranges), "mix-targets")
    placed = _placed(sizes, targets)
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = (placed.groupBy("source", "range").agg(F.sum("size").alias("range_size"), F.first("rest").alias("rest"))
            .withColumn("before", F.coalesce(F.sum("range_size").over(upto), F.lit(0))))
    edges = (sums.where(F.col("before") + F.col("range_size") > F.col("rest")).groupBy("source")
             .agg(F.min(F.struct("range", "before")).alias("e")).select("source", F.col("e.range").alias("edge"), F.col("e.before").alias("edge_before")))
    targets = materialise(_of_source(targets, edges), "mix-edges")
    # Rows of the edge, equal ones as one: of n rows on a place so many are taken as end, by half their size, within the rest.
    edge = (_placed(sizes, targets).where((F.col("range") == F.col("edge")) & (F.col("size") > 0))
            .groupBy("source", "edge_before", "rest", "key", "doc_id", "size").agg(F.count(F.lit(1)).alias("n")))
    within = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("edge_before") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(within), F.lit(0))
    edge = edge.withColumn("before", before)
    fit = F.floor((2 * F.col("rest") - (2 * F.col("before") - F.col("size"))) / (2 * F.col("size"))).cast("long")
    edge = edge.withColumn("fit", F.least(F.col("n"), F.greatest(F.lit(0), fit)))
    last = 2 * (F.col("before") + (F.col("fit") - 1) * F.col("size")) + F.col("size")
    edge = edge.withColumn("m", F.col("fit") - F.when((F.col("fit") > 0) & (last > 2 * F.col("rest")), 1).otherwise(0)).where("m > 0")
    cuts = edge.groupBy("source").agg(F.max(F.struct("key", "doc_id", "size", "m", "n")).alias("c"))
    cuts = cuts.select("source", F.struct("c.key", "c.doc_id", "c.size").alias("cut"), F.col("c.m").alias("cut_taken"), F.col("c.n").alias("cut_rows"))
    return materialise(_of_source(targets, cuts), "mix-plan")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it."""
    m = mix_sources(docs, keep=docs.columns, **options).where("copies > 0")
    return m.select("kept_columns", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("kept_columns.*")


def op8_query(docs: DataFrame) -> DataFrame:
    return mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) AS symbols FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
      FROM d GROUP BY source),
r AS (SELECT *, 3 * source_size AS cap, 3 * source_size / w::DOUBLE AS ratio, sum(source_size) OVER ()::BIGINT AS total FROM s),
v AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
             / (sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM r),
t AS (SELECT source, source_size, CASE WHEN ratio <= level THEN cap::DOUBLE
             ELSE max(level) FILTER (ratio > level) OVER () * w END AS target FROM v),
k AS (SELECT d.*, t.source_size, t.target,
        -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
          / greatest(0.05::DOUBLE, 1.0::DOUBLE - 2.0::DOUBLE * symbols / greatest(size, 1)) AS key
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
        CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS e FROM k),
c AS (SELECT *, CASE WHEN size > 0 THEN e + CASE WHEN 2 * before + size <= 2 * (target - e * source_size) THEN 1 ELSE 0 END
                ELSE 0 END::BIGINT AS copies FROM p)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM c
"""
