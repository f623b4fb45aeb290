"""Small tables with the awkward cases that every operator must take."""

import random
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHES = ("size", "y", "score", "rep", "bands", "key", "x", "block", "copies", "target", "label_id", "term", "found", "n", "range",
           "component", "text_a", "h", "kept_id", "symbols", "order", "copy", "tie", "host", "template", "clean_text")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

SENTENCE = "The quick brown fox jumps over the lazy dog near the old river bank. "


def awkward_texts() -> list:
    rnd = random.Random(5)
    long = " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9))) for _ in range(30_000))
    return [None, "", "   ", "\n\n", "one", "two words", "a b c d e", "x" * 20_000, long, SENTENCE * 3, SENTENCE * 3, SENTENCE * 3 + "extra",
            "Line one.\nLine one.\nLine two!", "héllo wörld ça été ñandú 中文 ☃", "  odd\u0085spaces\x1c", "<s> [#*$%&|<>] </s> <|endoftext|>",
            "A | B | C | D | E | F | G\nHome | About | Contact", "\tTabs\tand\r\nlines\x0b\x0c", "▁ ▁▁ mark"]


def awkward_docs(spark, clashes: bool = True):
    """Nulls in every column, empty and long texts, repeated rows, equal ids and sources, clashing extra columns."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 == 0 else f"s{i % 3}", len(t) if t else None) for i, t in enumerate(awkward_texts())]
    rows += [rows[9], rows[9], (None, "no id here at all", None, None, None), (None, None, None, None, None), (9, "another text under an old id", "en", "s0", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit(c).alias(c) for c in CLASHES]) if clashes else df


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int").select("*", F.lit(1).alias("y"), F.lit(2).alias("text"))


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
