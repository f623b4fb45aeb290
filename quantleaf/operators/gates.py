"""Constraints as a gate (V1, V2, S13): rows that break a table's rules are set aside with the rules they broke, and a table with
too many of them is refused.

A ``Gate`` names a table's key, its NOT NULL columns and further rules. ``report`` counts all violations in one pass over the
table (one aggregate by key); ``judged`` marks each row; both keep NULL keys and duplicates apart. Rows of a duplicated key are all set
aside: which of them is right cannot be told.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Refused(ValueError):
    """A table breaks its rules in more rows than its gate allows."""


@dataclass(frozen=True)
class Gate:
    keys: tuple[str, ...]
    required: tuple[str, ...] = ()
    #: name → SQL condition that a row must not fail (NULL passes)
    rules: dict[str, str] = field(default_factory=dict)
    max_share: float = 0.0

    def _row_rules(self) -> dict[str, object]:
        nulls = {f"{c} is NULL": F.col(c).isNull() for c in dict.fromkeys((*self.keys, *self.required))}
        return nulls | {name: ~F.coalesce(F.expr(cond), F.lit(True)) for name, cond in self.rules.items()}

    def report(self, df: DataFrame) -> dict[str, int]:
        """Rows that break each rule, and the rows in all ("rows")."""
        marks = {f"_{i}": cond for i, cond in enumerate(self._row_rules().values())}
        whole = F.lit(True)
        for k in self.keys:
            whole = whole & F.col(k).isNotNull()
        by_key = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c.cast("long")).alias(n) for n, c in marks.items()])
        row = by_key.agg(F.sum("_n").alias("rows"), F.sum(F.when(whole & (F.col("_n") > 1), F.col("_n"))).alias("duplicates"),
                         *[F.sum(n).alias(n) for n in marks]).first()
        return {"rows": row["rows"] or 0, "duplicate key": row["duplicates"] or 0,
                **{name: row[n] or 0 for n, name in zip(marks, self._row_rules(), strict=True)}}

    def judged(self, df: DataFrame) -> DataFrame:
        """``df`` with ``violations``: the names of the rules that a row breaks (empty: none)."""
        twice = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*self.keys, F.lit(True).alias("_twice"))
        rows = df.join(twice, list(self.keys), "left").select(*df.columns, "_twice")          # NULL keys meet nothing
        found = [F.when(F.col("_twice"), F.lit("duplicate key")), *[F.when(c, F.lit(n)) for n, c in self._row_rules().items()]]
        return rows.withColumn("violations", F.filter(F.array(*found), lambda v: v.isNotNull())).drop("_twice")

    def check(self, name: str, report: dict[str, int], rejected: int) -> None:
        if rejected > self.max_share * report["rows"]:
            broken = {k: v for k, v in report.items() if v and k != "rows"}
            raise Refused(f"{name}: {rejected} of {report['rows']} rows break its rules: {broken}")


#: Keys and NOT NULL columns of the silver tables.
SILVER_GATES = {
    "silver_stock_prices": Gate(("ticker", "trade_date"), rules={"high below low": "high_price >= low_price"}, max_share=0.01),
    "silver_forex_rates": Gate(("currency_pair", "trade_date"), ("close_rate",), max_share=0.01),
    "silver_stock_fundamentals": Gate(("ticker",), max_share=0.01),
    "silver_companies": Gate(("ticker",)),
    "silver_currency_map": Gate(("currency_code",)),
}
