"""Physical-plan assertions: the plans keep the shapes the design relies on."""

import contextlib
import io
import os

import pytest

from quantleaf.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_stock_performance_scans_prices_once_with_pushdown(spark):
    p = plan(catalog.queries()["gold_stock_performance"](spark, SF))
    scans = [ln for ln in p.splitlines() if ln.startswith("Location:") and "silver_stock_prices" in ln]
    assert len(scans) == 1, p
    assert "LessThanOrEqual(trade_date" in p           # as_of bound pushed to the Parquet scan
    assert "partial_max_by" in p and "HashAggregate" in p
    # column pruning: the scan reads only what the aggregate needs
    block = p.split("silver_stock_prices", 1)[1]
    schema = next(ln for ln in block.splitlines() if ln.startswith("ReadSchema:"))
    assert "daily_return_pct" in schema and "open_price" not in schema and "volume" not in schema


def test_correlation_has_no_date_self_join(spark):
    p = plan(catalog.queries()["gold_correlation_matrix"](spark, SF))
    assert "FlatMapGroupsInPandas" in p
    for ln in p.splitlines():
        if "Join" in ln and "keys" in ln.lower():
            assert "trade_date" not in ln


def test_lag_window_partitioned_by_ticker_and_bucket(spark):
    from quantleaf.config import EngineConfig
    from quantleaf.operators import silver as S
    from quantleaf.sources import proxy
    b = proxy.load(spark, SF)
    p = plan(S.clean_prices(b.prices, b.price_order, EngineConfig().minor_units), "simple")
    windows = [ln for ln in p.splitlines() if "Window [" in ln and "lag(" in ln]
    assert windows and all("_bkt" in ln for ln in windows)
    # dedupe: partial aggregate before the shuffle
    assert "partial_max_by" in p


def test_daily_inr_forces_no_broadcast(spark):
    """The currency map can come from any file: its join follows the planner's size checks."""
    from quantleaf.plans import catalog
    L = catalog.layers(spark, "/root/testdata/sf0.001")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        plan = catalog._daily(L)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
