"""Registered queries of the operators, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    alignment, byte_bpe, lexical_search, licenses, line_rules, merkle, mixing, neardups, quality_qda, suffix_repeats, token_counts, toxicity, wrappers,
)
from .common import table


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op10_neardups": lambda s, d: neardups.op10_query(table(s, d, "documents")),
        "op11_alignment": lambda s, d: alignment.op11_query(table(s, d, "documents")),
        "op12_suffix_repeats": lambda s, d: suffix_repeats.op12_query(table(s, d, "documents")),
        "op13_lexical_search": lambda s, d: lexical_search.op13_query(table(s, d, "documents"), table(s, d, "benchmark")),
        "op1_quality_qda": lambda s, d: quality_qda.op1_query(table(s, d, "documents"), table(s, d, "labels")),
        "op2_token_counts": lambda s, d: token_counts.op2_query(table(s, d, "documents")),
        "op3_merkle": lambda s, d: merkle.op3_query(table(s, d, "documents")),
        "op4_wrappers": lambda s, d: wrappers.op4_query(table(s, d, "pages")),
        "op5_licenses": lambda s, d: licenses.op5_query(table(s, d, "documents")),
        "op6_toxicity": lambda s, d: toxicity.op6_query(table(s, d, "documents"), table(s, d, "labels")),
        "op7_line_rules": lambda s, d: line_rules.op7_query(table(s, d, "documents")),
        "op8_mix_sources": lambda s, d: mixing.op8_query(table(s, d, "documents")),
        "op9_byte_bpe": lambda s, d: byte_bpe.op9_query(table(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op12_suffix_repeats": suffix_repeats.ORACLE_SQL,
        "op13_lexical_search": lexical_search.ORACLE_SQL,
        "op7_line_rules": line_rules.ORACLE_SQL,
        "op8_mix_sources": mixing.ORACLE_SQL,
    }
