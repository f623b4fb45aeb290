"""Driver contract: entry() and every registered query against its DuckDB oracle (sf0.001)."""

import decimal
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from quantleaf.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["ticker", "company_name"]


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries()) and set(catalog.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    want = Counter(tuple(norm(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall())
    assert got == want


def test_explicit_as_of_wins_over_cached_default(spark):
    import datetime as dt
    from quantleaf.config import EngineConfig
    from quantleaf.plans import catalog
    default = catalog.layers(spark, SF).cfg.as_of
    chosen = dt.date(2000, 6, 30)
    assert catalog.layers(spark, SF, EngineConfig(as_of=chosen)).cfg.as_of == chosen
    assert catalog.layers(spark, SF).cfg.as_of == default != chosen
