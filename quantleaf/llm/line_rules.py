"""Line-first cleaning (quality rules), in DataFrame functions only.

Each line is judged on its own — symbols, shouting, punctuation, navigation and boilerplate —
failing lines are removed, and a document that loses too much of its text is rejected.
A second group of columns holds plain counts of the whole text (words, symbols, repeated lines
and repeated 8-word windows) and the base verdict on them.

Everything is computed row by row inside a document's own arrays: no shuffle, so nothing
depends on how sources or copies are spread.

Defined results: a null or empty text, or one of white space only, has 0 words, fails the base
check and is rejected; its clean text is empty. Repeated rows and equal ids are judged each by
its own text. An empty table gives no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8

BOILERPLATE = (r"(?i)(all rights reserved|cookie policy|accept cookies|use cookies|enable javascript|lorem ipsum|"
               r"terms of use|terms of service|privacy policy|click here|sign up for|subscribe to|log in to)")


@dataclass(frozen=True)
class LineRules:
    """Limits per line and for the document."""
    symbols_per_100_words: int = 25     # of [#*$%&|<>]
    shouts_per_100_words: int = 30      # exclamation marks
    bars_per_100_words: int = 20        # navigation separators | › »
    boilerplate_words: int = 20         # boilerplate phrases count in lines up to this length
    bare_words: int = 40                # longer lines need some sentence punctuation
    max_lost_percent: int = 50          # words lost with failing lines
    min_words: int = 20
    max_repeat_percent: int = 30


def word_array(text: Column) -> Column:
    """Words of a text in order (null: none)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def word_count(text: Column) -> Column:
    """Number of words, without an array of them: each word with the space after it becomes one letter."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.length(F.regexp_replace(trimmed, WORD + r"[\x20\x09-\x0D]*", "x")).cast("long")


def count_of(text: Column, chars: str) -> Column:
    """How many characters of a class occur; ``chars`` is the inside of a character class."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{chars}]+", "")).cast("long")


def line_fails(line: Column, n_words: Column, rules: LineRules) -> Column:
    """Whether a line with ``n_words`` words (one at least) fails a rule."""
    return ((100 * count_of(line, r"#*$%&|<>") > rules.symbols_per_100_words * n_words)
            | (100 * count_of(line, "!") > rules.shouts_per_100_words * n_words)
            | (100 * count_of(line, "|›»") > rules.bars_per_100_words * n_words)
            | ((n_words <= rules.boilerplate_words) & line.rlike(BOILERPLATE))
            | ((n_words > rules.bare_words) & ~line.rlike(r"[.!?…:;]")))


def _repeat_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Adds ``out``: the words covered by 8-word windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash of their words, built by doubling (1, 2, 4, 8 words).
    Only texts with some repeated window sort their windows.
    """
    def doubled(h: Column, step: int) -> Column:
        n = F.greatest(F.size(h) - step, F.lit(0))
        return F.zip_with(F.slice(h, 1, n), F.slice(h, step + 1, n), lambda a, b: F.xxhash64(a, b))

    df = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        df = df.withColumn("_h", doubled(F.col("_h"), step))
    df = df.withColumn("_e", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, k: F.get("_e", k)["h"].eqNullSafe(x["h"])
    df = df.withColumn("_p", F.sort_array(F.transform(
        F.filter("_e", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])))
    gaps = F.zip_with(F.slice("_p", 1, F.size("_p") - 1), F.slice("_p", 2, F.size("_p") - 1),
                      lambda a, b: F.least(F.lit(WINDOW), b - a))
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda s, g: s + g)
    return df.withColumn(out, F.when(F.col("_p").isNotNull(), covered).otherwise(0).cast("long")).drop("_h", "_e", "_p")


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: id, clean_text, counts of the whole text, words lost, verdicts."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    df = (df.withColumn("_words", word_array(F.col("_text")))
            .withColumn("_lines", F.filter(
                F.transform(F.split(text, "\n", -1), lambda s: F.struct(s.alias("s"), word_count(s).alias("n"))),
                lambda x: x["n"] > 0))
            .withColumn("_kept", F.filter("_lines", lambda x: ~line_fails(x["s"], x["n"], rules)))
            .withColumn("n_words", F.size("_words").cast("long"))
            .withColumn("word_chars", F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long"))
            .withColumn("n_symbols", count_of(F.col("_text"), r"#*$%&|<>"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct(
                F.transform("_lines", lambda x: x["s"])))).cast("long"))
            .withColumn("kept_words", F.aggregate("_kept", F.lit(0).cast("long"), lambda s, x: s + x["n"]))
            .withColumn("clean_text", F.array_join(F.transform("_kept", lambda x: x["s"]), "\n")))
    df = _repeat_words(df, "_words", "n_repeat_words")
    base_failed = ((F.col("n_words") < rules.min_words)
                   | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))
    lost = 100 * (F.col("n_words") - F.col("kept_words")) > rules.max_lost_percent * F.col("n_words")
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept_words",
                     "clean_text", base_failed.alias("base_failed"), (~base_failed & ~lost).alias("kept"))


def op7_query(docs: DataFrame) -> DataFrame:
    return clean_lines(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                    "kept_words", "base_failed", "kept")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS p
      FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)),
g AS (SELECT r, p, CASE WHEN lead(w, 7) OVER o IS NOT NULL THEN
        concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o,
                  lead(w, 5) OVER o, lead(w, 6) OVER o, lead(w, 7) OVER o) END AS gram
      FROM w WINDOW o AS (PARTITION BY r ORDER BY p)),
f AS (SELECT r, p, CASE WHEN gram IS NOT NULL AND count(*) OVER (PARTITION BY r, gram) > 1 THEN 1 ELSE 0 END AS hit FROM g),
c AS (SELECT r, p, max(hit) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS cov FROM f),
rep AS (SELECT r, count(*) AS n_words, sum(cov) AS n_rep FROM c GROUP BY r),
l AS (SELECT r, s, len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) AS n
      FROM (SELECT r, unnest(string_split(t, chr(10))) AS s FROM d)),
j AS (SELECT r, s, n,
        100 * length(regexp_replace(s, '[^#*$%&|<>]+', '', 'g')) > 25 * n
        OR 100 * length(regexp_replace(s, '[^!]+', '', 'g')) > 30 * n
        OR 100 * length(regexp_replace(s, '[^|›»]+', '', 'g')) > 20 * n
        OR (n <= 20 AND regexp_matches(s, '(?i)(all rights reserved|cookie policy|accept cookies|use cookies|enable javascript|lorem ipsum|terms of use|terms of service|privacy policy|click here|sign up for|subscribe to|log in to)'))
        OR (n > 40 AND NOT regexp_matches(s, '[.!?…:;]')) AS bad
      FROM l WHERE n > 0),
ln AS (SELECT r, count(*) - count(DISTINCT s) AS dup, coalesce(sum(n) FILTER (NOT bad), 0) AS kw FROM j GROUP BY r),
a AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(n_rep, 0)::BIGINT AS n_repeat_words,
        coalesce(kw, 0)::BIGINT AS kept_words
      FROM d LEFT JOIN rep USING (r) LEFT JOIN ln USING (r))
SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
       AND NOT (100 * (n_words - kept_words) > 50 * n_words) AS kept
FROM a
"""
