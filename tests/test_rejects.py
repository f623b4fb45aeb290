"""Rejected payloads: every landed unit is accepted or set aside with its reason, in batch and stream."""

import datetime as dt
import json
import os
from decimal import Decimal as D

import pytest
from pyspark.errors import StreamingQueryException

from quantleaf.sources import ingest as I
from quantleaf.streaming import incremental as N

GOOD = {"symbol": "VOW3", "exchange": "XETR", "currency": "EUR", "fetched_at": "2025-01-03 00:00:00",
        "values": [{"datetime": "2025-01-02", "open": "1", "high": "1", "low": "1", "close": "10.5", "volume": "7"}]}


def entry(**given):
    return {**GOOD["values"][0], **given}


LINES = [
    json.dumps(GOOD),
    json.dumps({"code": 429, "message": "limit", "status": "error"}),
    '{"symbol": "VOW3", "values": [',
    "not json", "null", "[1, 2]", '{"symbol": "A", "values": "text"}',
    json.dumps({**GOOD, "values": []}), json.dumps({**GOOD, "values": None}), json.dumps({**GOOD, "symbol": " "}),
    json.dumps({**GOOD, "fetched_at": "soon"}),
    json.dumps({**GOOD, "values": [entry(), entry(close="n/a"), entry(datetime=None), entry(datetime="2025-02-30", volume="1.x"),
                                   entry(open=None), entry(close=12.25), None, entry(close="9" * 30)]}),
]
REASONS = sorted(["error response", "broken JSON", "broken JSON", "broken JSON", "broken JSON", "broken JSON", "no values", "no values", "no symbol",
                  "bad fetched_at", "bad close", "bad datetime", "bad datetime; bad volume", "empty entry", "bad close"])


def lines_of(spark, lines):
    return spark.createDataFrame([(x, "f") for x in lines], "value string, file string")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_every_unit_is_accepted_or_rejected(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        checked = I.check_payloads(lines_of(spark, LINES), I.PRICE_FEED)
        rejected = I.rejects(checked).collect()
        kept = I.accepted(checked, I.PRICE_FEED).collect()
        counts = I.unit_counts(checked).first()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert sorted(r.reason for r in rejected) == REASONS
    assert sorted(r.close_price for r in kept) == [D("10.5000"), D("10.5000"), D("10.5000"), D("12.2500")]
    assert {r.ticker for r in kept} == {"VOW"} and {r.exchange for r in kept} == {"XETRA"} and {r.trade_date for r in kept} == {dt.date(2025, 1, 2)}
    assert tuple(counts) == (19, 4, 15) and all(r.file == "f" for r in rejected)
    assert {r.text for r in rejected if r.reason == "broken JSON"} == {LINES[2], *LINES[3:7]}
    assert [json.loads(r.text)["volume"] for r in rejected if "bad volume" in r.reason] == ["1.x"]


def test_accepted_rows_equal_the_plain_parse(spark):
    good = [json.dumps({**GOOD, "symbol": s, "values": [entry(close=str(k)), entry(datetime="2025-01-04 00:00:00")]}) for k, s in enumerate(["A", "B", "VOW3"])]
    plain = I.parse_price_payloads(I.payloads_from_strings(lines_of(spark, good)))
    got = I.accepted(I.check_payloads(lines_of(spark, good), I.PRICE_FEED), I.PRICE_FEED)
    assert got.dtypes == plain.dtypes and sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_other_feeds(spark):
    fx = [json.dumps({"symbol": "USD/INR", "fetched_at": "2025-01-03 00:00:00", "values": [{"datetime": "2025-01-02", "close": c}]}) for c in ("85.1", "x")]
    checked = I.check_payloads(lines_of(spark, fx), I.FOREX_FEED)
    assert [r.close_rate for r in I.accepted(checked, I.FOREX_FEED).collect()] == [D("85.100000")]
    assert [r.reason for r in I.rejects(checked).collect()] == ["bad close"]
    fund = [json.dumps({"symbol": "VOW3.DE", "market_cap": "1000", "pe_ratio": p}) for p in ("4.5", "high")] + ["{"]
    checked = I.check_payloads(lines_of(spark, fund), I.FUNDAMENTALS_FEED, dt.datetime(2025, 1, 4))
    [row] = I.accepted(checked, I.FUNDAMENTALS_FEED).collect()
    assert (row.ticker, row.market_cap, row.pe_ratio, row.api_fetched_at) == ("VOW", 1000, D("4.5000"), dt.datetime(2025, 1, 4))
    assert sorted(r.reason for r in I.rejects(checked).collect()) == ["bad pe_ratio", "broken JSON"]


def test_no_lines(spark):
    checked = I.check_payloads(lines_of(spark, LINES).limit(0), I.PRICE_FEED)
    assert tuple(I.unit_counts(checked).first()) == (0, 0, 0)


def land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n\n")


def test_stream_keeps_rejects_and_counts(spark, tmp_dir):
    landing, bronze, checkpoint = (os.path.join(tmp_dir, x) for x in ("landing", "bronze", "checkpoint"))
    land(landing, "1.json", LINES)
    N.run_price_ingest(spark, landing, bronze, checkpoint, mode="all")
    land(landing, "2.json", LINES[:2])
    N.run_price_ingest(spark, landing, bronze, checkpoint, mode="all")
    assert N.bronze_rows(spark, bronze).count() == 5
    rejected = spark.read.parquet(bronze + N.REJECTS_SUFFIX).collect()
    assert sorted(r.reason for r in rejected) == sorted([*REASONS, "error response"]) and {r.file.rsplit("/")[-1] for r in rejected} == {"1.json", "2.json"}
    assert sorted((r.landed, r.accepted, r.rejected) for r in spark.read.parquet(bronze + N.COUNTS_SUFFIX).collect()) == [(2, 1, 1), (19, 4, 15)]


def test_too_many_rejects_stop_the_feed(spark, tmp_dir):
    landing, bronze, checkpoint = (os.path.join(tmp_dir, x) for x in ("landing", "bronze", "checkpoint"))
    land(landing, "1.json", LINES[:1])
    N.run_price_ingest(spark, landing, bronze, checkpoint, max_reject_share=0.5)
    land(landing, "2.json", [json.dumps({**GOOD, "values": [entry(datetime="2025-03-03")]}), "x", "y"])
    with pytest.raises(StreamingQueryException, match="2 of 3 units"):
        N.run_price_ingest(spark, landing, bronze, checkpoint, max_reject_share=0.5)
    assert N.bronze_rows(spark, bronze).count() == 1 and spark.read.parquet(bronze + N.REJECTS_SUFFIX).count() == 2
    N.run_price_ingest(spark, landing, bronze, checkpoint)       # allowed now: the batch runs again, nothing is doubled
    assert N.bronze_rows(spark, bronze).count() == 2 and spark.read.parquet(bronze + N.REJECTS_SUFFIX).count() == 2
