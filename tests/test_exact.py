"""Exact quotients: ties half away from zero, brute force in fractions, no double in the return plans."""

import random
import re
from decimal import ROUND_HALF_UP, Decimal as D
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quantleaf.config import EngineConfig
from quantleaf.functions import exprs as X
from quantleaf.operators import silver as S
from quantleaf.plans import refresh as P
from quantleaf.sources import proxy

SF = "/root/testdata/sf0.001"


def half_away(q: Fraction, scale: int) -> D:
    n = abs(q) * 10 ** scale
    whole = (2 * n.numerator + n.denominator) // (2 * n.denominator)
    return (D(whole) if q >= 0 else -D(whole)).scaleb(-scale)


def test_ties_round_away_from_zero(spark):
    rows = [("8", "8.00004"), ("8", "7.99996"), ("0.0016", "0.0017"), ("32", "32.0001"), ("32", "31.9999"), ("0", "5"), ("3", "0"), ("64", "64.00016")]
    df = spark.createDataFrame([(D(o), D(n)) for o, n in rows], "o decimal(28,10), n decimal(28,10)")
    got = [r.p for r in df.select(X.exact_pct("n", "o", 10).alias("p")).collect()]
    want = [half_away((Fraction(n) - Fraction(o)) * 100 / Fraction(o), 4) if Fraction(o) else None for o, n in rows]
    assert got == want
    assert want[3] == D("0.0003") and want[4] == D("-0.0003")          # 0.0003125: no tie; 0.00050 and 0.00025 are
    half = spark.createDataFrame([(D("8"), D("8.000004")), (D("8"), D("7.999996"))], "o decimal(18,6), n decimal(18,6)")
    assert [r.p for r in half.select(X.exact_pct("n", "o", 6).alias("p")).collect()] == [D("0.0001"), D("-0.0001")]     # 0.00005 %


def test_random_returns_equal_fractions(spark):
    rnd = random.Random(4)
    rows = [(D(rnd.randint(1, 10 ** rnd.randint(1, 14))).scaleb(-4), D(rnd.randint(0, 10 ** rnd.randint(1, 14))).scaleb(-4)) for _ in range(400)]
    rows = [r for r in rows if abs((r[1] - r[0]) / r[0] * 100) < 10 ** 13]
    df = spark.createDataFrame(rows, "o decimal(18,4), n decimal(18,4)")
    for r in df.select("o", "n", X.exact_pct("n", "o", 4).alias("p")).collect():
        assert r.p == half_away((Fraction(r.n) - Fraction(r.o)) * 100 / Fraction(r.o), 4)


def test_random_compound_equal_fractions(spark):
    rnd = random.Random(5)
    rows = [(D(rnd.randint(-10 ** 6, 10 ** 7)).scaleb(-4), D(rnd.randint(1, 10 ** 9)).scaleb(-6), D(rnd.randint(0, 10 ** 9)).scaleb(-6)) for _ in range(300)]
    df = spark.createDataFrame(rows, "r decimal(18,4), e decimal(18,6), s decimal(18,6)")
    got = df.select("r", "e", "s", X.exact_compound("r", "e", "s").alias("h"), X.exact_compound("r", "e", "s", True).alias("i")).collect()
    for g in got:
        if not g.s:
            assert g.h is None and g.i is None
            continue
        home = ((1 + Fraction(g.r) / 100) * Fraction(g.e) / Fraction(g.s) - 1) * 100
        assert g.h == half_away(home, 4) and g.i == half_away(home - Fraction(g.r), 4)


def test_sharpe_of_the_unrounded_return(spark):
    prices = spark.createDataFrame([("A", "2024-01-01", D("3")), ("A", "2025-06-01", D("4"))], "ticker string, d string, close_price decimal(18,4)").select(
        "ticker", F.to_date("d").alias("trade_date"), "close_price")
    stats = prices.groupBy("ticker").agg(F.max_by("close_price", "trade_date").alias("current_price"), F.min_by("close_price", "trade_date").alias("base_price"))
    cur, base, vol = (X.unscaled(c, 4) for c in ("current_price", "base_price", F.lit(D("7.0000"))))
    got = stats.select(X.exact_quotient((cur - base) * F.lit(D(10) ** 10), base * vol, 18, 4).alias("s")).first().s
    assert got == D("4.7619") == (D(100) / 3 / 7).quantize(D("0.0001"), ROUND_HALF_UP)


@pytest.mark.parametrize("name", ["silver_stock_prices", "silver_forex_rates", "gold_daily_inr_returns", "gold_currency_adjusted_returns"])
def test_no_double_in_returns(spark, name):
    """The stored bronze is decimal: above it no expression of a return is a double."""
    b = proxy.load(spark, SF)
    for t in ("prices", "forex", "fundamentals", "companies"):        # the fixture itself divides doubles: cut it off
        df = getattr(b, t)
        setattr(b, t, spark.createDataFrame([], df.schema))
    cfg = EngineConfig(as_of=__import__("datetime").date(1998, 1, 1))
    s = P.build_silver(b, cfg)
    df = {"silver_stock_prices": s.prices, "silver_forex_rates": s.forex}.get(name)
    if df is None:
        df = P.daily_inr(P.gold_inputs(s, cfg)) if name == "gold_daily_inr_returns" else P.currency_adjusted(P.gold_inputs(s, cfg))
    plan = df._jdf.queryExecution().analyzed().toString()
    plan = re.sub(r"stddev_samp\([^)]*\)", "", plan)          # the volatility is no quotient of decimals
    assert not re.search(r"(close|rate|price|pct|yoy)\w*#\d+ as double", plan), plan


def test_silver_return_is_exact(spark):
    rows = [("A", "2025-01-01", D("8.0000"), "GBp", 1), ("A", "2025-01-02", D("8.0001"), "GBp", 1), ("B", "2025-01-01", D("16.0000"), "USD", 1),
            ("B", "2025-01-02", D("16.0002"), "USD", 1), ("B", "2025-01-03", D("0"), "USD", 1), ("B", "2025-01-04", D("1"), "USD", 1)]
    b = spark.createDataFrame(rows, "ticker string, trade_date string, close_price decimal(18,4), currency string, fetch_seq int").select(
        "*", *[F.col("close_price").alias(c) for c in ("open_price", "high_price", "low_price")], F.lit(1).cast("long").alias("volume"))
    got = {(r.ticker, str(r.trade_date)): r.daily_return_pct for r in S.clean_prices(b, ["fetch_seq"], {"GBp": 100}).collect()}
    assert got[("A", "2025-01-02")] == D("0.0013") and got[("B", "2025-01-02")] == D("0.0013")     # 0.00125 % is a tie
    assert got[("B", "2025-01-03")] == D("-100.0000") and got[("B", "2025-01-04")] is None
