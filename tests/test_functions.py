"""Scalar helpers against the reference's worked examples (golden facts)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quantleaf.functions import exprs as X


def one(spark, expr, schema="x double"):
    return spark.range(1).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize("d, week", [
    (dt.date(2023, 1, 1), 1), (dt.date(2023, 1, 8), 2), (dt.date(2024, 12, 31), 53),
    (dt.date(2026, 1, 3), 1), (dt.date(2026, 1, 4), 2),
])
def test_tsql_week(spark, d, week):
    assert one(spark, X.tsql_week(F.lit(d))) == week


def test_weekday_sunday_is_one(spark):
    assert one(spark, X.tsql_weekday(F.lit(dt.date(2023, 1, 1)))) == 1


def test_quarter_end(spark):
    assert one(spark, X.quarter_end(F.lit(dt.date(2024, 2, 10)))) == dt.date(2024, 3, 31)


def test_year_back_leap_day(spark):
    assert one(spark, X.years_back(F.lit(dt.date(2024, 2, 29)))) == dt.date(2023, 2, 28)


def test_compound_fx_return(spark):
    # +20 % local, FX 83 → 86: +24.337 % at home
    v = one(spark, X.compound_pct(F.lit(20.0), F.lit(86.0), F.lit(83.0)))
    assert round(v, 3) == 24.337
    # +20 % local, FX +10 %: +32 %, impact 12 points
    v = one(spark, X.compound_pct(F.lit(20.0), F.lit(1.1), F.lit(1.0)))
    assert round(v, 6) == 32.0
    assert round(v - 20.0, 6) == 12.0


def test_pct_change_guards(spark):
    assert one(spark, X.pct_change(F.lit(6.0), F.lit(5.0))) == pytest.approx(20.0)
    assert one(spark, X.pct_change(F.lit(6.0), F.lit(0.0))) is None
    assert one(spark, X.pct_change(F.lit(6.0), F.lit(None).cast("double"))) is None


@pytest.mark.parametrize("c, label", [
    (0.7, "Strong Positive"), (0.3, "Weak Positive"), (-0.3, "Uncorrelated"), (-0.31, "Negative"),
])
def test_correlation_buckets(spark, c, label):
    assert one(spark, X.correlation_label(F.lit(c))) == label


def test_null_correlation_label(spark):
    null = F.lit(None).cast("double")
    assert one(spark, X.correlation_label(null)) is None
    assert one(spark, X.correlation_label(null, "Negative")) == "Negative"


def test_try_dec_overflow_is_null(spark):
    assert one(spark, X.try_dec(F.lit(1e9))) is None


def test_config_rejects_unknown_settings():
    from quantleaf.config import EngineConfig
    for bad in (dict(fx_policy="asoff"), dict(reference_variant="tsql"), dict(bucket_days=0),
                dict(minor_units={"GBp": 0})):
        with pytest.raises(ValueError):
            EngineConfig(**bad)
    assert EngineConfig(fx_policy="asof", reference_variant="sp").sp
