"""Bad landing records are set aside and their chunks fail."""

import datetime as dt
import json

from tickloom.plans.backfill import apply_backfill
from tickloom.sources.quarantine import check_landed_bars, check_landed_news, failed_chunks

MS = 1704153600000  # 2024-01-02 00:00 UTC
BAR = {"ticker": "A", "timestamp": MS, "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 10, "transactions": 3, "vwap": 1.2}
NEWS = {"id": "n1", "ticker": "A", "published_utc": "2024-01-02T10:00:00Z", "insights": [{"score": 0.5, "sentiment": "positive"}]}


def lines(spark, records):
    rows = [(k, r if isinstance(r, str) or r is None else json.dumps(r)) for k, r in enumerate(records)]
    return spark.createDataFrame(rows, "n int, value string")


def reasons(checked):
    return {row.n: row.reason for row in checked.bad.collect()}


def test_bars_and_their_reasons(spark):
    cases = [
        (BAR, None),
        ({**BAR, "volume": None, "transactions": None, "vwap": None}, None),
        ({**BAR, "ticker": None}, "missing ticker"),
        ({k: v for k, v in BAR.items() if k != "low"}, "missing low"),
        ({**BAR, "high": 1e8}, "out of range high"),
        ({**BAR, "high": 99999999.9999}, None),
        ({**BAR, "high": 99999999.99996}, "out of range high"),
        ({**BAR, "low": -1e8}, "out of range low"),
        ({**BAR, "vwap": 1e9}, "out of range vwap"),
        ({**BAR, "timestamp": 10**18}, "out of range timestamp"),
        ('{"ticker": "A", "timest', "corrupt record"),
        (json.dumps(BAR).replace("1.5", '"much"'), "corrupt record"),
        (json.dumps(BAR).replace("1.5", "NaN"), "out of range close"),
        ("", "corrupt record"),
        (None, "corrupt record"),
        ({**BAR, "close": None, "open": None}, "missing open"),
    ]
    checked = check_landed_bars(lines(spark, [r for r, _ in cases]), with_date=True, keep=("n",))
    assert reasons(checked) == {k: why for k, (_, why) in enumerate(cases) if why}
    good = {row.n: row for row in checked.good.collect()}
    assert sorted(good) == [k for k, (_, why) in enumerate(cases) if why is None]
    assert (good[0].ticker, good[0].date, good[0].close, good[0].volume_weighted_avg_price) == ("A", dt.date(2024, 1, 2), 1.5, 1.2)


def test_bad_records_keep_what_they_tell(spark):
    bad = check_landed_bars(lines(spark, [{**BAR, "close": None}, "{", {**BAR, "timestamp": 10**18}])).bad
    rows = {row.reason: (row.ticker, row.day) for row in bad.collect()}
    assert rows == {
        "missing close": ("A", dt.date(2024, 1, 2)),
        "corrupt record": (None, None),
        "out of range timestamp": ("A", None),
    }
    assert "{" in {row.record for row in bad.collect()}


def test_news_and_their_reasons(spark):
    cases = [
        (NEWS, None),
        ({**NEWS, "insights": [{"score": -1.004}, {"score": 7}]}, None),
        ({**NEWS, "insights": [{"score": 1.2}]}, "out of range score"),
        ({**NEWS, "published_utc": "soon"}, "out of range published_utc"),
        ({**NEWS, "id": None}, "missing id"),
        ("[1, ", "corrupt record"),
    ]
    checked = check_landed_news(lines(spark, [r for r, _ in cases]))
    assert sorted(r.reason for r in checked.bad.collect()) == sorted(why for _, why in cases if why)
    assert checked.good.count() == 2


def test_empty_input(spark):
    checked = check_landed_bars(lines(spark, []))
    assert checked.good.count() == 0 and checked.bad.count() == 0


def test_chunks_of_bad_records_fail(spark):
    day = 86400000
    records = [{**BAR, "timestamp": MS + k * day} for k in range(6)] + [{**BAR, "timestamp": MS + 4 * day, "close": None}] * 2 + ["{"]
    checked = check_landed_bars(lines(spark, records), with_date=True)
    chunks = [("A", dt.date(2024, 1, 1), dt.date(2024, 1, 4)), ("A", dt.date(2024, 1, 5), dt.date(2024, 1, 8))]
    plan = spark.createDataFrame(chunks, "ticker string, start_date date, end_date date")
    failures = failed_chunks(checked.bad, plan)
    assert [tuple(r) for r in failures.collect()] == [(*chunks[1], "2 bad records, among them: missing close")]
    done = apply_backfill(checked.good.limit(0), checked.good, plan, "daily", failures)
    assert sorted(r.date for r in done.table.collect()) == [dt.date(2024, 1, d) for d in (2, 3, 4)]
    ledger = {r.date_range_start: (r.status, r.rows_inserted, r.error_message) for r in done.ledger.collect()}
    assert ledger == {
        chunks[0][1]: ("completed", 3, None),
        chunks[1][1]: ("failed", 0, "2 bad records, among them: missing close"),
    }
