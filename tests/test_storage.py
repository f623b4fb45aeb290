"""Shared storage: identity of stored silver builds, and no scratch folder off local mode."""

import time

import pytest

from quantleaf import session
from quantleaf.config import EngineConfig
from quantleaf.plans import refresh as P


def test_fingerprint_sees_files_in_folders_config_and_version(spark, tmp_dir, monkeypatch):
    folder, cfg = f"{tmp_dir}/table", EngineConfig()
    spark.range(3).write.parquet(folder)
    first = P._fingerprint(spark, [folder], cfg)
    assert first == P._fingerprint(spark, [f"file:{folder}"], cfg)
    time.sleep(1.1)
    spark.range(5).write.mode("append").parquet(folder)
    second = P._fingerprint(spark, [folder], cfg)
    assert second != first
    assert P._fingerprint(spark, [folder], EngineConfig(bucket_days=30)) != second
    monkeypatch.setattr(P, "SILVER_VERSION", P.SILVER_VERSION + 1)
    assert P._fingerprint(spark, [folder], cfg) != second
    assert P._fingerprint(spark, [f"{tmp_dir}/missing"], cfg) is None
    assert P._exists(spark, folder) and P._exists(spark, f"file:{folder}/_SUCCESS") and not P._exists(spark, f"{tmp_dir}/missing")


def test_silver_queries_do_their_own_work(spark):
    """They read bronze, not a stored silver build."""
    from quantleaf.plans import catalog
    for name, table in (("silver_fundamentals", "part.parquet"),):
        plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert table in plan and "silver-" not in plan


def test_no_scratch_folder_on_a_cluster():
    class Conf:
        def __init__(self, master):
            self.values = {"spark.master": master}

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        conf = Conf("spark://host:7077")

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_output_contract(spark):
    from quantleaf import schemas
    from quantleaf.sources import proxy
    b = proxy.load(spark, "/root/testdata/sf0.001")
    for variant in ("dbt", "sp"):
        cfg = EngineConfig(reference_variant=variant)
        silver = P.build_silver(b, cfg)
        gold = P.build_gold(silver, cfg)
        assert set(gold) == set(schemas.GOLD) and set(P.SILVER_TABLES) == set(schemas.SILVER)
        for name, df in {**gold, "silver_stock_prices": silver.prices, "silver_forex_rates": silver.forex,
                         "silver_stock_fundamentals": silver.fundamentals}.items():
            schemas.check_contract(name, df)
    with pytest.raises(ValueError, match="gold_stock_performance"):
        schemas.check_contract("gold_stock_performance", gold["gold_stock_performance"].drop("roe"))
