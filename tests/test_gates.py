"""Constraint gates: what is set aside, what refuses a table, the refresh behind them; quarters as known on a day."""

import datetime as dt
import os

import pytest

from quantleaf.operators import silver as S
from quantleaf.operators.gates import Gate, Refused
from quantleaf.plans import versions as V

ROWS = [("A", 1, 5), ("A", 2, -1), (None, 3, 1), ("B", 1, 7), ("B", 1, 8), ("B", None, 2), (None, None, -2), ("C", 1, None), (None, 3, 1)]
GATE = Gate(("k", "d"), ("v",), {"negative": "v >= 0"})
BROKEN = {("A", 2, -1): ["negative"], ("B", 1, 7): ["duplicate key"], ("B", 1, 8): ["duplicate key"], (None, 3, 1): ["k is NULL"],
          ("B", None, 2): ["d is NULL"], (None, None, -2): ["k is NULL", "d is NULL", "negative"], ("C", 1, None): ["v is NULL"]}


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, "k string, d int, v int").repartition(3)


def test_rows_and_counts(spark):
    got = {tuple(r)[:3]: r.violations for r in GATE.judged(table(spark)).collect()}
    assert {k: v for k, v in got.items() if v} == BROKEN and got[("A", 1, 5)] == [] and GATE.judged(table(spark)).count() == len(ROWS)
    assert GATE.report(table(spark)) == {"rows": 9, "duplicate key": 2, "k is NULL": 3, "d is NULL": 2, "v is NULL": 1, "negative": 2}
    assert GATE.report(table(spark, []))["rows"] == 0


@pytest.mark.parametrize("kind", ["folder", "database"])
def test_gated_write(spark, tmp_dir, kind):
    target = os.path.join(tmp_dir, "t") if kind == "folder" else "ql_gated"
    if kind == "database":
        spark.sql("CREATE DATABASE IF NOT EXISTS ql_gated")
    with V.building(spark, target) as b:
        b.write_gated("t", table(spark, ROWS[:1]), GATE)
        b.publish()
    with pytest.raises(Refused, match="8 of 9 rows"):
        with V.building(spark, target) as b:
            b.write_gated("t", table(spark), GATE)
            b.publish()
    assert V.current(spark, target).table("t").count() == 1
    with V.building(spark, target) as b:
        kept = b.write_gated("t", table(spark), Gate(GATE.keys, GATE.required, GATE.rules, max_share=0.9))
        version = b.publish()
    assert [tuple(r) for r in kept.collect()] == [("A", 1, 5)] and sorted(version.names) == ["t", "t__rejected"]
    assert {tuple(r)[:3] for r in version.table("t__rejected").collect()} == set(BROKEN)
    assert [tuple(r) for r in V.current(spark, target).table("t").collect()] == [("A", 1, 5)]


def test_the_refresh_refuses_duplicated_companies(spark, tmp_dir):
    from quantleaf.plans import refresh as P
    from quantleaf.sources import proxy
    b = proxy.load(spark, "/root/testdata/sf0.001")
    P.refresh_all(spark, b, tmp_dir)
    b.companies = b.companies.unionByName(b.companies.limit(1))
    with pytest.raises(Refused, match="silver_companies: 2 of 26"):
        P.refresh_all(spark, b, tmp_dir)
    assert V.current(spark, tmp_dir).number == 1


def test_quarters_as_known(spark):
    d = dt.date
    rows = [("A", d(2024, 2, 1), d(2024, 5, 1), 1, 10), ("A", d(2024, 3, 31), d(2024, 6, 1), 2, 20), ("A", d(2024, 2, 1), d(2024, 7, 1), 3, 30),
            ("A", d(2024, 4, 1), d(2024, 6, 15), 4, 40), ("B", None, d(2024, 1, 1), 5, 50)]
    df = spark.createDataFrame(rows, "ticker string, report_date date, fetched_on date, fetch_seq long, v int")
    got = {(r.known_on, r.ticker, r.quarter_end): r.v for r in S.known_quarters(
        df, [d(2024, 4, 30), d(2024, 5, 31), d(2024, 6, 15), d(2024, 12, 31)], ["fetch_seq"], ["v"], digits=[12]).collect()}
    q1, q2 = d(2024, 3, 31), d(2024, 6, 30)
    assert got == {(d(2024, 5, 31), "A", q1): 10, (d(2024, 6, 15), "A", q1): 20, (d(2024, 6, 15), "A", q2): 40,
                   (d(2024, 12, 31), "A", q1): 30, (d(2024, 12, 31), "A", q2): 40}
