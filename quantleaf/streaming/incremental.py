"""ST1: incremental bronze ingestion with Structured Streaming.

Landed payload files are a file-source stream. Each micro-batch is parsed and
appended to bronze after the duplicate check against what bronze already holds
(``foreachBatch``). ``dropDuplicates`` is deliberately not used: it would keep the
*first* fetch of a key, while later layers take the *latest* fetch.

Exactly-once effect on a plain Parquet table: every micro-batch writes its own
partition ``_epoch=<query id>-<batch id>`` with dynamic partition overwrite. The query
id is the one Spark keeps in the checkpoint: a batch that is re-run after a failure
replaces its own partial output and checks duplicates only against the *other* epochs,
while another feed, or the same feed with a new checkpoint, writes partitions of its own, so
nothing is lost or doubled. The duplicate check reads only the batch's date range of
bronze (row-group min/max pruning), not the whole table; the keys found there are held
and counted before the join, so few keys are broadcast and the batch is not shuffled. A batch is
parsed once and held while it is checked and written, the text of its rejects only.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantleaf import schemas
from quantleaf.sources import ingest

EPOCH = "_epoch"
WATERMARK_SUFFIX = "_latest"   # per-epoch latest date per ticker, next to the bronze folder
REJECTS_SUFFIX, COUNTS_SUFFIX = "_rejects", "_counts"


def read_bronze(spark: SparkSession, bronze_dir: str) -> DataFrame | None:
    """Bronze as stored so far (all epochs, with the ``_epoch`` column), or None (any file system)."""
    try:
        return spark.read.parquet(bronze_dir)
    except AnalysisException:
        return None


def _latest_dates(spark: SparkSession, bronze_dir: str, epoch_id: str) -> DataFrame | None:
    """Latest stored date per ticker from the small watermark table (one row per ticker
    and epoch); bronze itself is aggregated only once, to bootstrap a missing table."""
    wm = read_bronze(spark, bronze_dir + WATERMARK_SUFFIX)
    if wm is not None:
        return (wm.where(F.col(EPOCH) != F.lit(epoch_id))
                .groupBy("ticker").agg(F.max("trade_date").alias("trade_date")))
    stored = read_bronze(spark, bronze_dir)
    if stored is None:
        return None
    return (stored.where(F.col(EPOCH) != F.lit(epoch_id))
            .groupBy("ticker").agg(F.max("trade_date").alias("trade_date")))


def ingest_batch(spark: SparkSession, batch: DataFrame, epoch_id: str, bronze_dir: str,
                 mode: str = "anti") -> None:
    """Append one micro-batch of bronze rows; idempotent per ``epoch_id``.

    mode: 'anti' appends rows whose (ticker, trade_date) is not stored yet (J12);
    'newer' appends rows after the latest stored date per ticker (S6), read from the
    watermark table kept next to bronze; 'all' appends every row (later layers take the
    latest fetch). A bronze folder is fed in one mode.
    """
    new, held = batch, None
    if mode == "newer":
        latest = _latest_dates(spark, bronze_dir, epoch_id)
        if latest is not None:
            new = ingest.newer_than_stored(latest, batch)
    elif mode == "anti":
        stored = read_bronze(spark, bronze_dir)
        if stored is not None:
            # An empty batch has no range: the filter is then NULL and the batch appends nothing.
            lo, hi = batch.agg(F.min("trade_date"), F.max("trade_date")).first()
            window = (stored.where(F.col(EPOCH) != F.lit(epoch_id))
                      .where(F.col("trade_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))))
            held = window.select("ticker", "trade_date").distinct().persist()
            held.count()        # the planner takes the size of the held keys
            new = ingest.not_yet_stored(held, batch)
    new = new.select(*schemas.BRONZE_PRICES.fieldNames()).withColumn(EPOCH, F.lit(epoch_id))
    try:
        _write_epoch(new, bronze_dir)
    finally:
        if held is not None:
            held.unpersist()
    if mode == "newer":
        # Written after bronze: a failure in between re-runs the epoch, which rewrites both.
        marks = spark.read.parquet(bronze_dir).where(F.col(EPOCH) == F.lit(epoch_id))
        _write_epoch(marks.groupBy("ticker", EPOCH).agg(F.max("trade_date").alias("trade_date")),
                     bronze_dir + WATERMARK_SUFFIX)


def _write_epoch(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(EPOCH).parquet(path))


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark wrote to the checkpoint's metadata when the query first started (any file system)."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


class TooManyRejects(RuntimeError):
    """A micro-batch holds more rejects than the feed allows; it is not appended."""


def ingest_checked(spark: SparkSession, checked: DataFrame, epoch_id: str, bronze_dir: str, mode: str = "anti",
                   max_reject_share: float | None = None) -> None:
    """Append the accepted units of a batch to bronze, its rejects and its counts to their own tables beside it.

    Rejects and counts are written first, so they can be looked at when the share of rejects stops the feed."""
    _write_epoch(ingest.rejects(checked).withColumn(EPOCH, F.lit(epoch_id)), bronze_dir + REJECTS_SUFFIX)
    counts = ingest.unit_counts(checked).first()
    _write_epoch(spark.createDataFrame([(*counts, epoch_id)], f"landed long, accepted long, rejected long, {EPOCH} string"),
                 bronze_dir + COUNTS_SUFFIX)
    if max_reject_share is not None and counts.rejected > max_reject_share * counts.landed:
        raise TooManyRejects(f"{counts.rejected} of {counts.landed} units of batch {epoch_id} are rejected")
    ingest_batch(spark, ingest.accepted(checked, ingest.PRICE_FEED), epoch_id, bronze_dir, mode)


def run_price_ingest(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint: str,
                     mode: str = "anti", max_files_per_trigger: int | None = None, max_reject_share: float | None = None) -> None:
    """Process every payload file available now, then stop (Trigger.AvailableNow).

    Documents and entries that can't be used go to ``<bronze>_rejects`` with their text, reason and file, the numbers of each
    micro-batch to ``<bronze>_counts``. A batch with a larger share of rejects than ``max_reject_share`` fails and stops the feed."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.text(landing_dir).select("value", F.col("_metadata.file_path").alias("file")).where("trim(value) != ''")
    units = ingest.without_accepted_text(ingest.check_payloads(lines, ingest.PRICE_FEED))

    def append(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        batch = batch.persist()
        try:
            ingest_checked(session, batch, f"{_query_id(session, checkpoint)}-{batch_id}", bronze_dir, mode, max_reject_share)
        finally:
            batch.unpersist()

    q = (units.writeStream
         .foreachBatch(append)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


def bronze_rows(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """The ingested bronze rows with the declared columns (epochs dropped)."""
    return spark.read.parquet(bronze_dir).select(*schemas.BRONZE_PRICES.fieldNames())
