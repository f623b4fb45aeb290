"""Cross rates against breadth-first search; trading days against counting day by day."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal as D

from quantleaf.operators import trading_days as TD
from quantleaf.operators.cross_rates import cross_rates


def search(quotes, base):
    """Fewest steps, then the first path by name, level by level."""
    edges = {}
    for pair, rate in quotes:
        a, b = pair.split("/")
        if rate and rate > 0 and a != b:
            edges[(a, b)] = min(edges.get((a, b), (2, 0)), (0, float(rate)))
            edges[(b, a)] = min(edges.get((b, a), (2, 0)), (1, 1.0 / float(rate)))
    reached, front, step = {base: (base, 1.0, 0)}, [base], 0
    while front:
        step += 1
        found = {}
        for (a, b), (_, r) in edges.items():
            if b in front and a not in reached:
                way = (f"{a}-{reached[b][0]}", r * reached[b][1])
                found[a] = min(found.get(a, way), way)
        reached |= {a: (*w, step) for a, w in found.items()}
        front = list(found)
    return {c: v for c, v in reached.items() if v[2]}


def test_cross_rates_equal_search(spark):
    rnd, rows, want = random.Random(9), [], {}
    currencies = ["INR", "USD", "EUR", "GBP", "JPY", "KRW", "CHF", "SEK"]
    for k in range(25):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=k)
        pairs = {f"{a}/{b}": D(rnd.randint(1, 10 ** 8)).scaleb(-6) if rnd.random() > 0.05 else rnd.choice([None, D(0)])
                 for a, b in (rnd.sample(currencies, 2) for _ in range(rnd.randint(1, 9)))}
        rows += [(p, day, r) for p, r in pairs.items()]
        for c, (path, rate, steps) in search(pairs.items(), "INR").items():
            want[(c, day)] = (path, steps, rate)
    got = cross_rates(spark.createDataFrame(rows, "currency_pair string, trade_date date, close_rate decimal(18,6)"), "INR").collect()
    assert {(r.currency, r.trade_date): (r.path, r.steps) for r in got} == {k: v[:2] for k, v in want.items()} and max(r.steps for r in got) >= 3
    for r in got:
        assert abs(float(r.rate) - want[(r.currency, r.trade_date)][2]) <= 1e-6 * max(1, want[(r.currency, r.trade_date)][2])


def test_direct_inverted_and_unreachable(spark):
    d = dt.date(2024, 1, 1)
    rows = [("USD/INR", d, D("80")), ("INR/JPY", d, D("2")), ("EUR/USD", d, D("1.25")), ("CHF/SEK", d, D("10")), ("INR/USD", d, D("0.0126"))]
    got = {r.currency: (r.rate, r.path, r.steps) for r in cross_rates(spark.createDataFrame(rows, "currency_pair string, trade_date date, close_rate decimal(18,6)"), "INR").collect()}
    assert got == {"USD": (D("80.000000"), "USD-INR", 1), "JPY": (D("0.500000"), "JPY-INR", 1), "EUR": (D("100.000000"), "EUR-USD-INR", 2)}
    assert D("0.5") == (1 / D(2)).quantize(D("0.1"), ROUND_HALF_UP)
    assert cross_rates(spark.createDataFrame([], "currency_pair string, trade_date date, close_rate decimal(18,6)"), "INR").collect() == []


def open_days(holidays, start, end):
    days = [start + dt.timedelta(days=k) for k in range((end - start).days + 1)]
    return [d for d in days if d.weekday() < 5 and d not in holidays]


def test_trading_days(spark):
    start, end = dt.date(2024, 12, 2), dt.date(2025, 1, 20)
    holidays = {"A": [dt.date(2024, 12, 25), dt.date(2025, 1, 1)], "B": [dt.date(2024, 12, 24), dt.date(2024, 12, 25), dt.date(2024, 12, 26)], "C": []}
    h = spark.createDataFrame([(x, d) for x, ds in holidays.items() for d in ds * 2], "exchange string, date_key date")
    exchanges = spark.createDataFrame([("A",), ("B",), ("C",), ("A",)], "exchange string")
    cal = TD.trading_calendar(exchanges, h, start, end)
    for x, ds in holidays.items():
        days = open_days(ds, start, end)
        assert [r.date_key for r in cal.where(f"exchange = '{x}' AND is_trading_day").orderBy("date_key").collect()] == days
        assert [r.ordinal for r in cal.where(f"exchange = '{x}' AND is_trading_day").orderBy("date_key").collect()] == list(range(1, len(days) + 1))
    rows = spark.createDataFrame([(x, start + dt.timedelta(days=k)) for x in "ABC" for k in range(0, 50)], "exchange string, d date")
    for n in (0, 1, 5):
        for r in TD.trading_days_before(rows, cal, n, "d", "before").collect():
            upto = [d for d in open_days(holidays[r.exchange], start, end) if d <= r.d] if r.d <= end else []
            assert r.before == (upto[-1 - n] if len(upto) > n else None)


def test_freshness_and_gaps_with_holidays(spark):
    start, end = dt.date(2024, 12, 2), dt.date(2025, 1, 20)
    h = spark.createDataFrame([("A", dt.date(2024, 12, 25)), ("A", dt.date(2024, 12, 26)), ("B", dt.date(2024, 12, 25))], "exchange string, date_key date")
    companies = spark.createDataFrame([("T1", "A"), ("T2", "B"), ("T3", "B"), ("T4", "A")], "ticker string, exchange string")
    cal = TD.trading_calendar(companies, h, start, end)
    prices = spark.createDataFrame([("T1", dt.date(2024, 12, 23)), ("T1", dt.date(2024, 12, 24)), ("T1", dt.date(2025, 1, 10)), ("T2", dt.date(2024, 12, 24)),
                                    ("T3", dt.date(2024, 12, 24)), ("T3", dt.date(2024, 12, 26)), ("T3", dt.date(2024, 12, 25))], "ticker string, trade_date date")
    got = {r.ticker: tuple(r)[2:] for r in TD.freshness_by_exchange(prices, companies, cal, dt.date(2024, 12, 27)).collect()}
    assert got == {"T1": (dt.date(2024, 12, 24), dt.date(2024, 12, 24), 0, True), "T2": (dt.date(2024, 12, 24), dt.date(2024, 12, 26), 1, False),
                   "T3": (dt.date(2024, 12, 26), dt.date(2024, 12, 26), 0, True), "T4": (None, dt.date(2024, 12, 24), None, False)}
    gaps = {r.ticker: tuple(r)[4:] for r in TD.trading_gaps(prices, companies, cal).collect()}
    n = len(open_days([dt.date(2024, 12, 25), dt.date(2024, 12, 26)], dt.date(2024, 12, 23), dt.date(2025, 1, 10)))
    assert gaps == {"T1": (n, 3, n - 3, 0), "T2": (1, 1, 0, 0), "T3": (2, 2, 0, 1)}
