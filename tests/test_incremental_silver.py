"""Incremental silver against a full rebuild: corrections, late days, gaps, re-sent and empty feeds, parts touched."""

import datetime as dt
import os
import random
from decimal import Decimal as D

from quantleaf.config import EngineConfig
from quantleaf.operators import silver as S
from quantleaf.plans import incremental_silver as N
from quantleaf.plans import versions as V

CFG = EngineConfig(bucket_days=30)
ORDER, DIGITS = ["fetch_seq"], [12]
SCHEMA = ("ticker string, trade_date date, open_price decimal(18,4), high_price decimal(18,4), low_price decimal(18,4), close_price decimal(18,4), "
          "volume long, currency string, fetch_seq long")


def quote(ticker, day, close, seq, currency="USD"):
    p = D(close)
    return (ticker, dt.date(2024, 1, 1) + dt.timedelta(days=day), p, p, p, p, 1, currency, seq)


def rebuilt(spark, rows):
    df = S.clean_prices(spark.createDataFrame(rows, SCHEMA), ORDER, CFG.minor_units, CFG.bucket_days)
    return sorted(map(tuple, df.collect()))


def feed(spark, rows, target):
    return N.apply_feed(spark, spark.createDataFrame(rows, SCHEMA), target, CFG, ORDER, DIGITS)


def test_three_feeds_equal_a_rebuild(spark, tmp_dir):
    target, rnd, rows = os.path.join(tmp_dir, "silver"), random.Random(3), []
    for k in range(4):
        new = [quote(rnd.choice(["A", "B", "C"]), rnd.randint(0, 400) if k else 3 * rnd.randint(0, 130), f"{rnd.randint(1, 9999)}.{rnd.randint(0, 9999):04d}",
                     1000 * k + i, rnd.choice(["USD", "GBp"])) for i in range(150 if not k else 12)]
        rows += new
        version = feed(spark, new, target)
        assert sorted(map(tuple, N.silver_prices(version).collect())) == rebuilt(spark, rows)
        if k == 2:
            assert len(version.names) > 10
    again = feed(spark, new, target)             # the last feed is sent again
    assert sorted(map(tuple, N.silver_prices(again).collect())) == rebuilt(spark, rows)


def test_only_touched_buckets_and_the_next_are_written(spark, tmp_dir):
    target = os.path.join(tmp_dir, "silver")
    base = [quote(t, d, "10", i) for t in "AB" for i, d in enumerate(range(0, 300, 5))]
    first = feed(spark, base, target)
    parts = lambda v, kind: {int(n.split("/")[1]): p for n, p in v.places.items() if n.startswith(kind)}
    buckets = sorted(parts(first, "silver"))
    # a correction inside a bucket, not of its last day: that bucket alone
    day = [r[1] for r in base if N_bucket(r[1]) == buckets[3]][1]
    second = feed(spark, [("A", day, *[D("11")] * 4, 1, "USD", 9999)], target)
    changed = {b for b in buckets if parts(second, "silver")[b] != parts(first, "silver")[b]}
    assert changed == {buckets[3]} and {b for b in buckets if parts(second, "state")[b] != parts(first, "state")[b]} == {buckets[3]}
    # of its last day: the next bucket's first return changes too
    last = max(r[1] for r in base if N_bucket(r[1]) == buckets[5])
    third = feed(spark, [("A", last, *[D("20")] * 4, 1, "USD", 10000)], target)
    changed = {b for b in buckets if parts(third, "silver")[b] != parts(second, "silver")[b]}
    assert changed == {buckets[5], buckets[6]}
    assert sorted(map(tuple, N.silver_prices(third).collect())) == rebuilt(spark, [*base, ("A", day, *[D("11")] * 4, 1, "USD", 9999),
                                                                                   ("A", last, *[D("20")] * 4, 1, "USD", 10000)])
    # the earlier versions read as before; removing them leaves the shared parts
    assert sorted(map(tuple, N.silver_prices(first).collect())) == rebuilt(spark, base)
    assert V.vacuum(spark, target, keep=1) == [1, 2]
    assert N.silver_prices(V.current(spark, target)).count() == len(base)


def N_bucket(day):
    return (day - dt.date(1970, 1, 1)).days // CFG.bucket_days


def test_older_fetch_and_empty_feeds(spark, tmp_dir):
    target = os.path.join(tmp_dir, "silver")
    empty = feed(spark, [], target)
    assert empty.number == 1 and not N._parts(empty, "silver")
    feed(spark, [quote("A", 0, "10", 5), quote("A", 40, "12", 5)], target)
    late = feed(spark, [quote("A", 0, "99", 4)], target)            # an older fetch that arrives late does not win
    assert [r.close_price for r in N.silver_prices(late).orderBy("trade_date").collect()] == [D("10.0000"), D("12.0000")]
    assert feed(spark, [], target).number == late.number
    gap = feed(spark, [quote("A", 20, "8", 6)], target)              # fills a gap before the second row
    assert [r.daily_return_pct for r in N.silver_prices(gap).orderBy("trade_date").collect()] == [None, D("-20.0000"), D("50.0000")]
