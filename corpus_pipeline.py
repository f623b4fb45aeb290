"""Corpus pipeline: quality, toxicity, near-duplicates, source mix, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. Between stages the rows are written as Parquet to the shared folder and read again, so a lost executor
costs one stage's tasks and not the chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quantleaf.llm import byte_bpe, mixing, neardups, quality_qda, toxicity
from quantleaf.llm.common import importable, materialise, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (operator 1); it is fitted on the labelled rows of ``docs``."""
    return quality_qda.keep_good(docs, table(spark, sf_dir, "labels"))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject (operator 6)."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id (operator 10)."""
    importable(spark)
    return neardups.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them (operator 8)."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of each document (operator 9)."""
    importable(spark)
    return byte_bpe.digest_documents(docs)


STAGES = [("quality", quality), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("mix", mix), ("encode", encode)]

#: SQL can express neither the fitted classifiers nor BPE; tests/llm/test_pipeline.py replays the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
