"""Gaps, merges, the ledger, plans, export and the stream."""

import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from tickloom.operators import quality
from tickloom.operators.ledger import backfill_plan, get_last_fetch_date, last_fetch, resolve_date_ranges
from tickloom.operators.upsert import DAILY_POLICY, INTRADAY_POLICY, NEWS_POLICY, KeyIndex, merge_batch, month_of, news_defaults, upsert_table
from tickloom.plans.backfill import apply_backfill
from tickloom.plans.daily import prepare_daily_features
from tickloom.plans.export import default_name, export_features_to_parquet
from tickloom.plans.intraday import prepare_intraday_features
from tickloom.sources.landing import bars_from_landing, news_from_landing, read_landing_bars, read_landing_news
from tickloom.sources.symbols import backfill_tickers, symbol_dimension, with_market_index
from tickloom.sources.tables import MarketTables, filter_tickers, load_daily_bars, load_intraday_bars
from tickloom.streaming.landing import ingest_bars

D = dt.date
TODAY = D(2025, 11, 7)


def dates(rows, *days, ticker="A"):
    return rows([(ticker, d) for d in days], "ticker string, date date")


def stamps(rows, *times, ticker="A"):
    return rows([(ticker, t) for t in times], "ticker string, timestamp timestamp")


# -- gaps -------------------------------------------------------------------------------
HOLIDAY_PAIRS = [
    (D(2023, 12, 22), D(2023, 12, 26)),
    (D(2024, 1, 12), D(2024, 1, 16)),
    (D(2024, 3, 28), D(2024, 4, 1)),
]


@pytest.mark.parametrize("pair", HOLIDAY_PAIRS)
def test_holiday_gaps_are_dropped(rows, pair, spark):
    assert quality.daily_gaps(dates(rows, *pair)).count() == 0
    calendar = rows([(d,) for d in quality.HOLIDAYS], "holiday date")
    assert quality.daily_gaps(dates(rows, *pair), calendar).count() == 0


def test_other_gaps_are_kept(rows, layout):
    found = quality.daily_gaps(dates(rows, D(2024, 3, 1), D(2024, 3, 6), D(2024, 3, 9))).collect()
    assert [(r["previous_date"], r["gap_days"]) for r in found] == [(D(2024, 3, 1), 5)]
    calendar = rows([(D(2024, 3, 2),)], "holiday date")  # a Saturday
    assert quality.daily_gaps(dates(rows, D(2024, 3, 1), D(2024, 3, 6)), calendar).count() == 1


def test_one_missing_bar(rows, layout):
    nine = dt.datetime(2024, 1, 2, 9)
    gaps = quality.intraday_gaps(stamps(rows, nine + dt.timedelta(minutes=5), nine + dt.timedelta(minutes=15)))
    row = gaps.first()
    assert row["first_missing"] == row["last_missing"] == nine + dt.timedelta(minutes=10)
    assert (row["missing_count"], row["gap_minutes"]) == (1, 10.0)


@pytest.mark.parametrize("seconds,kept", [(201900, 0), (29100, 0), (29101, 1), (450, 0), (451, 1)])
def test_closed_market_steps_are_exact(rows, seconds, kept):
    start = dt.datetime(2024, 1, 2, 9)
    assert quality.intraday_gaps(stamps(rows, start, start + dt.timedelta(seconds=seconds))).count() == kept


def test_boundary_rows(rows, layout):
    t = [dt.datetime(2024, 1, 2, 9, m) for m in (0, 5, 10)]
    frame = stamps(rows, *t).unionByName(stamps(rows, t[1], ticker="B"))
    _, flagged = quality.flag_missing_neighbors(frame)
    found = {(r["ticker"], r["timestamp"], r["missing_previous_bar"], r["missing_next_bar"]) for r in flagged.collect()}
    assert found == {("A", t[0], 1, 0), ("A", t[2], 0, 1), ("B", t[1], 1, 1)}


def test_fetch_ranges_join_dates_a_week_apart(rows, layout):
    days = dates(rows, D(2024, 1, 1), D(2024, 1, 8), D(2024, 1, 16), D(2024, 1, 16), D(2024, 1, 17))
    found = quality.fetch_ranges(days).orderBy("range_start").collect()
    assert [(r["range_start"], r["range_end"], r["dates"]) for r in found] == [
        (D(2024, 1, 1), D(2024, 1, 8), 2),
        (D(2024, 1, 16), D(2024, 1, 17), 2),
    ]


def test_gap_summary_has_the_bounds(rows):
    start = dt.datetime(2024, 1, 2, 9)
    times = [start + dt.timedelta(minutes=m) for m in (0, 20, 100, 105)]
    row = quality.gap_summary(quality.intraday_gaps(stamps(rows, *times))).first()
    assert (row["gaps"], row["missing_bars"]) == (2, 18)
    assert (row["first_missing"], row["last_missing"]) == (start + dt.timedelta(minutes=5), start + dt.timedelta(minutes=95))


def test_gap_fill_counts(rows):
    start = dt.datetime(2025, 6, 2, 14)
    old = dt.datetime(2020, 6, 2, 14)
    seen = stamps(rows, *[t + dt.timedelta(minutes=m) for t in (old, start) for m in (0, 15)])
    gaps = quality.intraday_gaps(seen).filter("gap_minutes < 60")
    landed = stamps(rows, start + dt.timedelta(minutes=5), start + dt.timedelta(minutes=7))
    filled = quality.fill_gaps(gaps, landed, TODAY, 2)
    assert [r["timestamp"] for r in filled.bars.collect()] == [start + dt.timedelta(minutes=5)]
    assert filled.summary.first().asDict() == {"dates_processed": 1, "bars_inserted": 1, "errors": 0, "skipped_old": 1}
    nothing = quality.fill_gaps(gaps, landed.filter("false"), TODAY, 2).summary.first()
    assert (nothing["errors"], nothing["bars_inserted"]) == (1, 0)


# -- merge --------------------------------------------------------------------------------
BAR = (
    "ticker string, date date, open double, high double, low double, close double, volume long, transactions long, "
    "volume_weighted_avg_price double"
)


def bar(d, close, ticker="A"):
    return (ticker, d, 1.0, 2.0, 0.5, close, 10, 1, 1.5)


def test_last_row_of_a_batch_wins_and_a_second_run_changes_nothing(rows):
    base = rows([bar(D(2024, 1, 1), 1.0), bar(D(2024, 1, 2), 2.0)], BAR)
    batch = rows([(*bar(D(2024, 1, 2), 5.0), 1), (*bar(D(2024, 1, 2), 7.0), 2), (*bar(D(2024, 1, 3), 3.0), 3)], BAR + ", n int")
    once = merge_batch(base, batch, DAILY_POLICY, sequence="n")
    twice = merge_batch(once, batch, DAILY_POLICY, sequence="n")
    want = {(D(2024, 1, 1), 1.0), (D(2024, 1, 2), 7.0), (D(2024, 1, 3), 3.0)}
    for frame in (once, twice):
        assert {(r["date"], r["close"]) for r in frame.collect()} == want and frame.count() == 3


def test_update_stamps(rows):
    then, now = dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1)
    base = rows([(*bar(D(2024, 1, 1), 1.0), then, then), (*bar(D(2024, 1, 2), 1.0), then, then)], BAR + ", created_at timestamp, updated_at timestamp")
    batch = rows([bar(D(2024, 1, 2), 2.0), bar(D(2024, 1, 3), 2.0)], BAR)
    out = merge_batch(base, batch, DAILY_POLICY, F.lit(now)).orderBy("date").collect()
    assert [(r["created_at"], r["updated_at"]) for r in out] == [(then, then), (then, now), (now, now)]


def test_news_keep_their_first_ticker(rows):
    schema = (
        "id string, ticker string, published_at timestamp, title string, description string, url string, author string, "
        "type string, sentiment_score decimal(3,2), sentiment_label string, sentiment_reasoning string, "
        "keywords array<string>, tickers array<string>"
    )
    at = dt.datetime(2024, 1, 1)
    base = rows([("n1", "A", at, "old", "d", "u", "w", "article", None, None, None, ["k"], ["A"])], schema)
    incoming = news_defaults(rows([("n1", "B", at, "new", "", "text")], "id string, ticker string, published_at timestamp, title string, description string, text string"))
    row = merge_batch(base, incoming, NEWS_POLICY).first()
    assert (row["ticker"], row["title"], row["description"], row["url"], row["keywords"]) == ("A", "new", "text", "u", [])


def test_table_merge_rewrites_only_touched_months(spark, rows, tmp_path):
    path = str(tmp_path / "bars")
    base = rows([bar(D(2024, 1, 1), 1.0), bar(D(2024, 2, 1), 1.0)], BAR).withColumn("month", month_of("date"))
    base.coalesce(1).write.partitionBy("month").parquet(path)
    before = set(os.listdir(os.path.join(path, "month=2024-01")))
    batch = rows([bar(D(2024, 2, 1), 9.0), bar(D(2024, 3, 1), 4.0)], BAR).withColumn("month", month_of("date"))
    upsert_table(spark, path, batch, DAILY_POLICY)
    spark.catalog.refreshByPath(path)
    out = {(r["date"], r["close"]) for r in spark.read.parquet(path).collect()}
    assert out == {(D(2024, 1, 1), 1.0), (D(2024, 2, 1), 9.0), (D(2024, 3, 1), 4.0)}
    assert set(os.listdir(os.path.join(path, "month=2024-01"))) == before


# -- ledger and plans ---------------------------------------------------------------------------
LEDGER = "ticker string, data_type string, last_fetch_date date, status string, updated_at timestamp"


def ledger(rows, day, kind="daily", status="completed"):
    return rows([("A", kind, day, status, dt.datetime(2025, 1, 1))], LEDGER)


def one(df):
    return [(r["start_date"], r["end_date"]) for r in df.orderBy("start_date").collect()]


def test_full_range(rows):
    who = rows([("A",)], "ticker string")
    got = resolve_date_ranges(who, None, "daily", "full", TODAY, start_date="2025-11-04")
    assert one(got) == [(D(2025, 11, 4), D(2025, 11, 6))]
    late = resolve_date_ranges(who, None, "daily", "full", TODAY, start_date="2025-11-04", end_date="2026-01-01")
    assert one(late) == [(D(2025, 11, 4), D(2025, 11, 6))]
    with pytest.raises(ValueError):
        resolve_date_ranges(who, None, "daily", "full", TODAY)
    with pytest.raises(ValueError):
        resolve_date_ranges(who, None, "daily", "other", TODAY)


def test_resume_ranges(rows):
    who = rows([("A",)], "ticker string")
    got = resolve_date_ranges(who, ledger(rows, D(2025, 11, 6)), "daily", "resume", TODAY)
    assert one(got) == [(D(2025, 11, 6), D(2025, 11, 6))]
    for other in (None, ledger(rows, D(2025, 11, 6), "news"), ledger(rows, D(2025, 11, 6), status="failed")):
        got = resolve_date_ranges(who, other, "daily", "resume", TODAY, lookback_days=5)
        assert one(got) == [(D(2025, 11, 1), D(2025, 11, 6))]


@pytest.mark.parametrize(
    "kind,mode,start,end,want",
    [
        ("news", "resume", D(2025, 10, 1), D(2025, 10, 10), [(D(2025, 10, 1), D(2025, 10, 7)), (D(2025, 10, 8), D(2025, 10, 10))]),
        (
            "news",
            "full",
            D(2025, 10, 1),
            D(2025, 10, 20),
            [(D(2025, 10, 1), D(2025, 10, 7)), (D(2025, 10, 8), D(2025, 10, 14)), (D(2025, 10, 15), D(2025, 10, 20))],
        ),
        ("daily", "resume", D(2024, 1, 1), D(2024, 2, 15), [(D(2024, 1, 1), D(2024, 1, 30)), (D(2024, 1, 31), D(2024, 2, 15))]),
        ("intraday", "resume", D(2025, 8, 1), D(2025, 8, 31), [(D(2025, 8, 1), D(2025, 8, 30)), (D(2025, 8, 31), D(2025, 8, 31))]),
    ],
)
def test_plan_chunks(rows, kind, mode, start, end, want):
    who = rows([("A",)], "ticker string")
    if mode == "full":
        got = backfill_plan(who, None, kind, mode, TODAY, start, end)
    else:
        got = backfill_plan(who, ledger(rows, start - dt.timedelta(days=1), kind), kind, mode, TODAY, None, end)
    assert one(got) == want


def test_latest_ledger_row(rows):
    entries = rows(
        [
            ("A", "daily", D(2025, 1, 5), "completed", dt.datetime(2025, 1, 6)),
            ("A", "daily", D(2025, 1, 3), "completed", dt.datetime(2025, 1, 7)),
            ("A", "daily", D(2025, 1, 9), "failed", dt.datetime(2025, 1, 8)),
        ],
        LEDGER,
    )
    assert last_fetch(entries).first()["last_fetch_date"] == D(2025, 1, 3)
    assert get_last_fetch_date(entries, "A", "daily") == D(2025, 1, 3)
    assert get_last_fetch_date(entries, "A", "news") is None


def test_backfill_reports_every_chunk(rows):
    plan = rows([(t, D(2024, 1, 1), D(2024, 1, 5)) for t in ("OK", "EMPTY", "BAD")], "ticker string, start_date date, end_date date")
    landed = rows([bar(D(2024, 1, 2), 5.0, "OK"), bar(D(2024, 2, 2), 5.0, "OK"), bar(D(2024, 1, 2), 5.0, "BAD")], BAR)
    failed = rows([("BAD", D(2024, 1, 1), D(2024, 1, 5), "boom")], "ticker string, start_date date, end_date date, error_message string")
    done = apply_backfill(landed.filter("false"), landed, plan, "daily", failed)
    assert [(r["ticker"], r["date"]) for r in done.table.collect()] == [("OK", D(2024, 1, 2))]
    report = {r["ticker"]: (r["status"], r["rows_inserted"], r["error_message"], r["last_success_date"]) for r in done.ledger.collect()}
    end = D(2024, 1, 5)
    assert report == {"OK": ("completed", 1, None, end), "EMPTY": ("completed", 0, None, end), "BAD": ("failed", 0, "boom", None)}


# -- sources -----------------------------------------------------------------------------------------
def test_ticker_filter(rows):
    frame = dates(rows, D(2024, 1, 1)).unionByName(dates(rows, D(2024, 1, 1), ticker="B"))
    assert [filter_tickers(frame, t).count() for t in (None, "A", ["A", "B"], [], ("B",))] == [2, 1, 2, 2, 1]
    with pytest.raises(TypeError):
        filter_tickers(frame, 5)


def test_symbols(spark, rows):
    symbols = symbol_dimension(spark)
    assert symbols.count() == 47 and backfill_tickers(symbols).count() == 48
    assert {r["market_index"] for r in with_market_index(rows([("AAPL",), ("ZZ",)], "ticker string"), symbols).collect()} == {"SPY"}


def test_landing_records(spark, tmp_path):
    bars, news = tmp_path / "bars.json", tmp_path / "news.json"
    bars.write_text(json.dumps({"ticker": "A", "timestamp": 1704205800000, "open": 1, "high": 2, "low": 0.5, "close": 1.5, "volume": 7, "transactions": 2, "vwap": 1.2}))
    insight = {"score": 0.3, "sentiment": "positive", "sentiment_reasoning": "why"}
    articles = [
        {"id": "1", "ticker": "A", "published_utc": "2024-01-02T14:30:00Z", "insights": [insight, {"score": 0.9}], "tickers": [], "article_url": "u"},
        {"id": "2", "ticker": "A", "published_utc": "2024-01-02T14:30:00Z", "insights": []},
    ]
    news.write_text("\n".join(json.dumps(a) for a in articles))
    row = bars_from_landing(read_landing_bars(spark, str(bars)), with_date=True).first()
    assert (row["timestamp"], row["date"], row["volume_weighted_avg_price"]) == (dt.datetime(2024, 1, 2, 14, 30), D(2024, 1, 2), 1.2)
    landed = read_landing_news(spark, str(news))
    (first,) = news_from_landing(landed).collect()
    assert (first["sentiment_score"], first["title"], first["url"], first["tickers"], first["keywords"]) == (0.3, "", "u", ["A"], [])
    assert first["published_at"] == dt.datetime(2024, 1, 2, 14, 30)
    assert news_from_landing(landed, only_with_insights=False).count() == 2


def test_loaders(rows):
    daily = rows([bar(D(2024, 1, 5), 1.0), bar(D(2024, 1, 8), 1.0), bar(D(2024, 1, 16), 1.0)], BAR)
    loaded, gaps = load_daily_bars(daily)
    got = [(r["is_monday"], r["is_friday"], r["days_since_prev_close"]) for r in loaded.orderBy("date").collect()]
    assert got == [(0, 1, 0), (1, 0, 3), (0, 0, 8)] and gaps.count() == 0  # a holiday lies inside
    ticks = daily.withColumn("timestamp", F.col("date").cast("timestamp")).drop("date")
    bars, _ = load_intraday_bars(ticks)
    assert [r["seconds_since_prev_bar"] for r in bars.orderBy("timestamp").collect()] == [0, 259200, 691200]


# -- whole plans ------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def tables(spark):
    from conftest import SMALL
    from tickloom.registry import views

    daily = views.bars_daily(spark, SMALL)
    index = daily.filter("ticker = '2-HIGH'").withColumn("ticker", F.lit("SPY"))
    return MarketTables(daily.unionByName(index), views.bars_intraday(spark, SMALL), views.news(spark, SMALL))


def test_daily_plan(tables, tmp_path):
    path = str(tmp_path / "daily")
    done = prepare_daily_features(tables, ["1-URGENT", "2-HIGH"], path, include_news_features=True)
    assert len(done.features.columns) == 116
    stored = done.features.sparkSession.read.parquet(path)
    assert stored.count() == done.features.count() > 0
    assert stored.filter("ticker = '2-HIGH' and abs(stock_vs_market_return) > 1e-12").count() == 0
    assert len(prepare_daily_features(tables, "1-URGENT").features.columns) == 101
    without_index = MarketTables(tables.daily.filter("ticker <> 'SPY'"))
    alone = prepare_daily_features(without_index, "1-URGENT").features
    assert len(alone.columns) == 101 and alone.count() > 0 and alone.filter("market_close IS NOT NULL").count() == 0


def test_every_ticker_meets_its_own_index(tables, rows):
    symbols = rows([("1-URGENT", "3-MEDIUM"), ("2-HIGH", "2-HIGH")], "ticker string, market_index string")
    own = MarketTables(tables.daily, symbols=symbols)
    out = prepare_daily_features(own, ["1-URGENT", "2-HIGH"]).features
    assert {r["ticker"] for r in out.select("ticker").distinct().collect()} <= {"1-URGENT", "2-HIGH"}
    assert out.filter("ticker = '2-HIGH' and abs(stock_vs_market_return) > 1e-12").count() == 0
    assert out.filter("ticker = '1-URGENT' and abs(stock_vs_market_return) > 1e-12").count() > 0


def test_intraday_plan(tables):
    done = prepare_intraday_features(tables, as_of=D(2024, 3, 1), expected_interval_minutes=30)
    assert done.features.count() > 0 and done.gaps.count() > 0 and done.neighbors.count() > 0
    landed = tables.intraday.withColumn("ticker", F.lit("click")).dropDuplicates(["ticker", "timestamp"])
    filled = prepare_intraday_features(tables, as_of=D(2024, 3, 1), landed=landed, expected_interval_minutes=30)
    def missing(result):
        return result.gaps.agg(F.sum("missing_count")).first()[0]

    assert missing(filled) < missing(done)
    assert prepare_intraday_features(tables).features.count() > 0
    assert prepare_intraday_features(tables, as_of=D(2030, 1, 1), max_years_back=2).features.count() == 0


def test_export(tables, spark, tmp_path):
    path = export_features_to_parquet(tables, "news", str(tmp_path / "news"), "1-URGENT")
    assert spark.read.parquet(path).count() == tables.news.filter("ticker = '1-URGENT'").count()
    nothing = export_features_to_parquet(tables, "news", str(tmp_path / "none"), "NONE")
    assert spark.read.parquet(nothing).count() == 0
    for kind, time in (("daily", "date"), ("intraday", "timestamp")):
        written = spark.read.parquet(export_features_to_parquet(tables, kind, str(tmp_path / kind)))
        assert time in written.columns and written.count() > 0
    assert default_name("daily", None, dt.datetime(2024, 1, 2, 3, 4, 5)).endswith("daily_features_all_20240102_030405.parquet")
    with pytest.raises(ValueError):
        export_features_to_parquet(tables, "weekly", str(tmp_path / "weekly"))


def test_stream_resumes_and_merges(spark, tmp_path):
    landing, table, progress = (str(tmp_path / n) for n in ("landing", "table", "progress"))
    os.makedirs(landing)

    def land(name, *records):
        with open(os.path.join(landing, name), "w") as f:
            f.write("\n".join(json.dumps({"ticker": "A", "timestamp": ms, "open": 1, "high": 2, "low": 0.5, "close": c, "volume": 1}) for ms, c in records))

    def run():
        ingest_bars(spark, landing, table, progress, INTRADAY_POLICY).awaitTermination()
        spark.catalog.refreshByPath(table)
        return {r["timestamp"].minute: r["close"] for r in spark.read.parquet(table).collect()}

    land("a.json", (1704205800000, 1.0), (1704206100000, 2.0))
    assert run() == {30: 1.0, 35: 2.0}
    land("b.json", (1704206100000, 9.0), (1704206400000, 3.0))
    assert run() == {30: 1.0, 35: 9.0, 40: 3.0}


def test_the_later_landing_file_wins(spark, tmp_path):
    landing, table, progress = (str(tmp_path / n) for n in ("landing", "table", "progress"))
    os.makedirs(landing)
    for k, (close, filler) in enumerate([(1.0, 0), (2.0, 400)]):
        name = os.path.join(landing, f"{k:04d}.json")
        with open(name, "w") as f:
            for ms in (1704205800000, *range(1704300000000, 1704300000000 + filler * 60000, 60000)):
                f.write(json.dumps({"ticker": "A", "timestamp": ms, "open": 1, "high": 2, "low": 0.5, "close": close, "volume": 1}) + "\n")
        os.utime(name, (1_700_000_000 + k, 1_700_000_000 + k))
    ingest_bars(spark, landing, table, progress, INTRADAY_POLICY).awaitTermination()
    spark.catalog.refreshByPath(table)
    assert spark.read.parquet(table).filter("timestamp = '2024-01-02 14:30:00'").first()["close"] == 2.0


def test_stored_news_keep_their_month(spark, rows, tmp_path):
    path = str(tmp_path / "news")
    at = dt.datetime(2024, 1, 5)
    schema = "id string, ticker string, published_at timestamp, title string, text string"
    base = news_defaults(rows([("a", "A", at, "old", "t"), ("b", "A", at, "old", "t")], schema)).withColumn("month", month_of("published_at"))
    base.write.partitionBy("month").parquet(path)
    batch = news_defaults(rows([("a", "A", dt.datetime(2024, 3, 1), "new", "t"), ("c", "A", dt.datetime(2024, 3, 1), "new", "t")], schema)).withColumn("month", month_of("published_at"))
    upsert_table(spark, path, batch, NEWS_POLICY, key_fixes_partition=False)
    spark.catalog.refreshByPath(path)
    out = {(r["id"], r["title"], str(r["month"])) for r in spark.read.parquet(path).collect()}
    assert out == {("a", "new", "2024-01"), ("b", "old", "2024-01"), ("c", "new", "2024-03")}


def test_rows_without_a_month_stay(spark, rows, tmp_path):
    path = str(tmp_path / "news")
    schema = "id string, ticker string, published_at timestamp, title string, text string"
    base = news_defaults(rows([("a", "A", None, "old", "t"), ("b", "A", dt.datetime(2020, 1, 5), "old", "t")], schema)).withColumn("month", month_of("published_at"))
    base.write.partitionBy("month").parquet(path)
    batch = news_defaults(rows([("c", "A", None, "new", "t"), ("a", "A", None, "new", "t")], schema)).withColumn("month", month_of("published_at"))
    upsert_table(spark, path, batch, NEWS_POLICY, key_fixes_partition=False)
    spark.catalog.refreshByPath(path)
    assert {(r["id"], r["title"], r["month"]) for r in spark.read.parquet(path).collect()} == {("a", "new", None), ("b", "old", "2020-01"), ("c", "new", None)}


def test_index_reads_only_touched_buckets(spark, rows, tmp_path):
    index = KeyIndex(str(tmp_path / "index"), ("id",), buckets=8)
    stored = rows([(f"n{k}", "2024-01" if k % 2 else None) for k in range(200)], "id string, month string")
    index.build(stored)
    batch = rows([("n7", "2024-05"), ("n8", "2024-05"), ("x", "2024-05")], "id string, month string")
    known = index.of_keys(batch)
    plan = known._jdf.queryExecution().executedPlan().toString()
    touched = re.search(r"PartitionFilters: \[[^\]]*key_bucket#\d+ IN \(([^)]*)\)", plan)
    assert touched and len(touched.group(1).split(",")) <= 3
    assert {tuple(r) for r in known.collect()} == {("n7", "2024-01"), ("n8", None)}
    index.add(batch, known)
    spark.catalog.refreshByPath(index.path)
    assert {tuple(r) for r in index.of_keys(batch).collect()} == {("n7", "2024-01"), ("n8", None), ("x", "2024-05")}


def test_a_broken_load_is_repeated_to_the_same_state(spark, rows, tmp_path, monkeypatch):
    """The run breaks off between table and ledger, is repeated, and repeated once more."""
    from tickloom.plans import backfill

    schema = "ticker string, date date, open double, high double, low double, close double, volume long, transactions long, volume_weighted_avg_price double"

    def bar(day, close):
        return ("A", dt.date(2024, 1, day), 1.0, 2.0, 0.5, close, 10, 1, 1.0)

    plan = rows([("A", dt.date(2024, 1, 1), dt.date(2024, 1, 5)), ("A", dt.date(2024, 1, 6), dt.date(2024, 1, 9))], "ticker string, start_date date, end_date date")
    landed = rows([bar(day, 9.0) for day in range(3, 9)], schema)
    at = F.lit("2024-02-01").cast("timestamp")

    def folder(name):
        root = str(tmp_path / name)
        rows([bar(day, 1.0) for day in range(1, 5)], schema).withColumn("month", month_of("date")).write.partitionBy("month").parquet(f"{root}/table")
        return root

    def load(root):
        return backfill.store_backfill(spark, f"{root}/table", f"{root}/ledger", landed, plan, "daily", None, at, batch_id="b1")

    def state(root):
        spark.catalog.refreshByPath(f"{root}/table")
        spark.catalog.refreshByPath(f"{root}/ledger")
        return [sorted(map(str, spark.read.parquet(f"{root}/{t}").collect())) for t in ("table", "ledger")]

    whole, broken = folder("whole"), folder("broken")
    assert load(whole)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(backfill, "append_ledger", fail)
        with pytest.raises(OSError):
            load(broken)
    assert load(broken) and not load(broken)
    assert state(broken) == state(whole) and len(state(broken)[1]) == 2
