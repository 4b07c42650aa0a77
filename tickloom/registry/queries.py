"""Registered queries: one or more per operator, over whole tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from datetime import date
from itertools import count
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import NewsFeatureConfig, PriceFeatureConfig, TechnicalIndicatorConfig, VolumeFeatureConfig
from ..functions.expressions import complete_rows, q
from ..operators import candles, confluence, market, news, price, quality, technical, volume
from ..operators.clock import market_hours_only, time_features
from ..operators.ledger import backfill_plan, last_fetch, resolve_date_ranges
from ..operators.panel import run_blocks
from ..operators.sentiment import combine_sentiment_scores, rule_sentiment
from ..operators.upsert import DAILY_POLICY, INTRADAY_POLICY, NEWS_POLICY, KeyIndex, merge_batch, month_of, upsert_table
from ..plans.backfill import apply_backfill, fill_stored_gaps, store_backfill
from ..plans.daily import INTRADAY_COLUMNS, confluence_table, daily_from_intraday, prepare_daily_features, row_counts
from ..plans.export import export_features_to_parquet
from ..plans.intraday import intraday_table, prepare_intraday_features
from ..schemas import LANDING_BARS, LANDING_NEWS
from ..sources.landing import bars_from_landing, news_from_landing
from ..sources.quarantine import check_landed_bars, failed_chunks
from ..sources.symbols import backfill_tickers
from ..sources.tables import MarketTables, load_daily_bars, load_index, load_intraday_bars, load_news, news_between
from . import views
from .digits import digits_of

Query = Callable[[SparkSession, str], DataFrame]

P, V, X, N = PriceFeatureConfig(), VolumeFeatureConfig(), TechnicalIndicatorConfig(), NewsFeatureConfig()
# Dates of the sample data that stand in for holidays.
SAMPLE_HOLIDAYS = (date(1995, 1, 16), date(1996, 7, 4), date(1998, 12, 25), date(2000, 5, 29))
# Words that occur in the sample texts, for both sides of the lexicon.
SAMPLE_POSITIVE = ("les", "que", "au", "de", "of", "the", "der", "und", "el")
SAMPLE_NEGATIVE = ("un", "en", "la", "le", "and", "die", "des", "los", "in")
AS_OF = date(2001, 8, 15)


def shown(df: DataFrame) -> DataFrame:
    """Columns as the checker compares them: doubles rounded, timestamps without zone."""
    out = []
    for field in df.schema.fields:
        name = field.name
        if isinstance(field.dataType, (T.DoubleType, T.DecimalType)):
            value, digits = f"CAST(`{name}` AS DOUBLE)", digits_of(name)
            out.append(f"{value if digits is None else f'round({value}, {digits})'} AS `{name}`")
        elif isinstance(field.dataType, T.TimestampType):
            out.append(f"CAST(`{name}` AS TIMESTAMP_NTZ) AS `{name}`")
        else:
            out.append(f"`{name}`")
    return df.selectExpr(*out)


def _keyed(df: DataFrame, key: tuple[str, ...], names) -> DataFrame:
    return shown(df.select(*[q(c) for c in dict.fromkeys([*key, *names])]))


def _daily(*blocks, names=None) -> Query:
    """Query that runs blocks over the daily bars and returns their columns."""
    wanted = names or [c for b in blocks for c in b.columns()]

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _keyed(run_blocks(views.bars_daily(spark, folder), *blocks), ("ticker", "date"), wanted)

    return query


def _sparse(*blocks, names=None) -> Query:
    """The same over every calendar day of a ticker, days without a bar having no prices."""
    wanted = names or [c for b in blocks for c in b.columns()]

    def query(spark: SparkSession, folder: str) -> DataFrame:
        bars = views.bars_daily(spark, folder)
        spans = bars.groupBy("ticker").agg(F.min("date").alias("a"), F.max("date").alias("b"))
        days = spans.select("ticker", F.explode(F.sequence("a", "b")).alias("date"))
        return _keyed(run_blocks(days.join(bars, ["ticker", "date"], "left"), *blocks), ("ticker", "date"), wanted)

    return query


def _index_columns(spark: SparkSession, folder: str) -> DataFrame:
    return market.index_returns(views.index_daily(spark, folder))


def _confluence(spark: SparkSession, folder: str, with_news: bool = False, **options) -> DataFrame:
    return confluence_table(
        views.bars_daily(spark, folder),
        None,
        views.news(spark, folder) if with_news else None,
        index=_index_columns(spark, folder),
        **options,
    )


def bars_daily(spark, folder):
    return shown(views.bars_daily(spark, folder))


def bars_intraday(spark, folder):
    return shown(views.bars_intraday(spark, folder))


def loaded_daily(spark, folder):
    bars, _ = load_daily_bars(views.bars_daily(spark, folder), ["1-URGENT", "2-HIGH", "5-LOW"])
    return shown(bars)


def loaded_intraday(spark, folder):
    bars, _ = load_intraday_bars(views.bars_intraday(spark, folder))
    return _keyed(bars, ("ticker", "timestamp"), ("date", "is_monday", "is_friday", "seconds_since_prev_bar"))


def market_relative(spark, folder):
    out = market.market_features(views.bars_daily(spark, folder), views.index_daily(spark, folder))
    return _keyed(out, ("ticker", "date"), ("daily_return", *market.MARKET_COLUMNS))


def beta(spark, folder):
    out = market.market_features(views.bars_daily(spark, folder), views.index_daily(spark, folder), beta=True)
    return _keyed(out, ("ticker", "date"), ("beta_20d",))


def confluence_flags(spark, folder):
    return _keyed(_confluence(spark, folder, True), ("ticker", "date"), confluence.CONFLUENCE_COLUMNS[:14])


def confluence_scores(spark, folder):
    table = confluence_table(views.bars_event_days(spark, folder), views.bars_intraday(spark, folder))
    return _keyed(table, ("ticker", "date"), (*INTRADAY_COLUMNS, *confluence.CONFLUENCE_COLUMNS))


def daily_features(spark, folder):
    return shown(complete_rows(_confluence(spark, folder)))


def daily_features_with_news(spark, folder):
    return _keyed(complete_rows(_confluence(spark, folder, True)), ("ticker", "date"), news.NEWS_COLUMNS)


def feature_row_counts(spark, folder):
    return row_counts(complete_rows(_confluence(spark, folder)))


def candle_shape(spark, folder):
    out = candles.candle_features(views.bars_intraday(spark, folder))
    return _keyed(out, ("ticker", "timestamp"), (*candles.shape_columns(), *candles.range_columns()))


def candle_momentum(spark, folder):
    out = candles.candle_features(views.bars_intraday(spark, folder))
    return _keyed(out, ("ticker", "timestamp"), candles.momentum_columns())


def candle_patterns(spark, folder):
    out = candles.candle_features(views.bars_intraday(spark, folder))
    return _keyed(out, ("ticker", "timestamp"), candles.pattern_columns())


def session_clock(spark, folder):
    out = time_features(views.bars_intraday(spark, folder))
    return shown(out.drop("open", "high", "low", "close", "volume", "transactions", "volume_weighted_avg_price"))


def market_hours(spark, folder):
    return shown(market_hours_only(views.bars_intraday(spark, folder)))


def intraday_volume(spark, folder):
    out = volume.volume_features(views.bars_intraday(spark, folder), V, order="timestamp")
    return _keyed(out, ("ticker", "timestamp"), [c for b in volume.volume_blocks(V) for c in b.columns()])


def neighbor_flags(spark, folder):
    _, flagged = quality.flag_missing_neighbors(views.bars_intraday(spark, folder))
    return shown(flagged)


def intraday_features(spark, folder):
    return shown(complete_rows(intraday_table(views.bars_intraday(spark, folder))))


def intraday_daily_rollup(spark, folder):
    return shown(daily_from_intraday(views.bars_intraday(spark, folder)))


def daily_gaps(spark, folder):
    return quality.daily_gaps(views.bars_daily(spark, folder), SAMPLE_HOLIDAYS)


def _gaps(spark, folder):
    return quality.intraday_gaps(views.bars_intraday(spark, folder), 30)


def intraday_gaps(spark, folder):
    return shown(_gaps(spark, folder))


def missing_timestamps(spark, folder):
    return shown(quality.missing_bars(_gaps(spark, folder)))


def gap_ranges(spark, folder):
    days = views.bars_daily(spark, folder).select("ticker", "date")
    return quality.fetch_ranges(days, max_gap_days=2)


def gap_summary(spark, folder):
    return shown(quality.gap_summary(_gaps(spark, folder)))


def _landed_for_gaps(spark, folder):
    """Bars of the alphabetically next event type, as if fetched for this one."""
    turn = {"click": "error", "error": "purchase", "purchase": "signup", "signup": "view", "view": "click"}
    renamed = F.coalesce(*[F.when(F.col("ticker") == a, F.lit(b)) for a, b in turn.items()])
    return views.bars_intraday(spark, folder).withColumn("ticker", renamed)


def _filled(spark, folder):
    return quality.fill_gaps(_gaps(spark, folder), _landed_for_gaps(spark, folder))


def gap_fill(spark, folder):
    return shown(_filled(spark, folder).bars)


def gap_fill_summary(spark, folder):
    return _filled(spark, folder).summary


def _gaps_filled(spark, folder):
    """Folder and result of a stored fill whose source has bars of other hours at each of its first three calls."""
    root, landed, calls = _new_folder(spark), _landed_for_gaps(spark, folder), count()
    bars = views.bars_intraday(spark, folder)
    bars.withColumn("month", month_of("timestamp")).repartition("month").write.partitionBy("month").parquet(f"{root}/table")

    def landing(ranges):
        days = ranges.select("ticker", F.explode(F.sequence("range_start", "range_end")).alias("_day"))
        asked = landed.withColumn("_day", F.to_date("timestamp")).join(days, ["ticker", "_day"], "left_semi").drop("_day")
        return asked.filter(F.hour("timestamp") % 3 <= next(calls))

    return root, fill_stored_gaps(spark, f"{root}/table", landing, f"{root}/work", 30)


def gap_fill_stored(spark, folder):
    root, _ = _gaps_filled(spark, folder)
    return shown(spark.read.parquet(f"{root}/table").drop("month"))


def gap_fill_remaining(spark, folder):
    _, done = _gaps_filled(spark, folder)
    return shown(done.gaps.select("ticker", "previous_timestamp", "current_timestamp", "missing_count"))


def news_daily(spark, folder):
    return shown(news.news_daily(views.news(spark, folder)))


def news_rolling(spark, folder):
    out = news.news_rolling(news.news_daily(views.news(spark, folder)))
    return _keyed(out, ("ticker", "date"), ("news_rolling_count", "sentiment_rolling_avg"))


def news_trend(spark, folder):
    out = news.news_rolling(news.news_daily(views.news(spark, folder)))
    return _keyed(out, ("ticker", "date"), ("sentiment_trend",))


def news_attached(spark, folder):
    bars = views.bars_daily(spark, folder).select("ticker", "date")
    return shown(news.attach_news(bars, views.news(spark, folder)))


def news_latest(spark, folder):
    rows = news_between(views.news(spark, folder), "1995-02-01", "1995-12-31")
    return shown(rows.select("id", "ticker", "published_at", "author", "type"))


def lexicon_sentiment(spark, folder):
    scored = rule_sentiment(
        views.news(spark, folder), "description", SAMPLE_POSITIVE, SAMPLE_NEGATIVE
    )
    return shown(scored.select("id", "sentiment_rule_score", "sentiment_rule_label"))


def combined_sentiment(spark, folder):
    out = combine_sentiment_scores(
        views.news(spark, folder), positive_words=SAMPLE_POSITIVE, negative_words=SAMPLE_NEGATIVE
    )
    return shown(out.select("id", "sentiment_rule_score", "sentiment_vendor_score", "sentiment_score", "sentiment_label"))


def _landing_json(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Records as they land: one JSON text each, parsed with the landing schema."""
    text = df.select(F.to_json(F.struct(*df.columns)).alias("record"))
    return text.select(F.from_json("record", schema).alias("r")).select("r.*")


def landing_bars(spark, folder):
    events = views.table(spark, folder, "events")
    price_fields = [F.col("value").alias(n) for n in ("open", "high", "low", "close", "vwap")]
    records = events.select(
        F.col("event_type").alias("ticker"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        *price_fields,
        F.col("user_id").alias("volume"),
        F.get_json_object("props", "$.k").cast("long").alias("transactions"),
    )
    return shown(bars_from_landing(_landing_json(records, LANDING_BARS), with_date=True))


def _checked_bars(spark, folder):
    """Bar records of all events, four in ten of them broken in one of four ways."""
    events, way = views.table(spark, folder, "events"), F.col("event_id") % 10
    records = events.select(
        "event_id",
        F.when(way != 1, F.col("event_type")).alias("ticker"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(way == 3, F.col("value") * 1e7).otherwise(F.col("value")).alias("open"),
        F.col("value").alias("high"),
        F.col("value").alias("low"),
        F.when(way != 4, F.col("value")).alias("close"),
    )
    text = F.to_json(F.struct(*records.columns[1:]))
    lines = records.select("event_id", F.when(way == 2, F.substring(text, 1, 20)).otherwise(text).alias("value"))
    return check_landed_bars(lines, with_date=True, keep=("event_id",))


def landing_quarantine(spark, folder):
    checked = _checked_bars(spark, folder)
    good = checked.good.select("event_id", F.lit(None).cast("string").alias("reason"), "ticker", F.col("date").alias("day"), "close")
    bad = checked.bad.select("event_id", "reason", "ticker", "day", F.lit(None).cast("double").alias("close"))
    return shown(good.unionByName(bad))


def landing_failed_chunks(spark, folder):
    tickers = views.table(spark, folder, "events").select(F.col("event_type").alias("ticker")).distinct()
    plan = backfill_plan(tickers, None, "news", "full", AS_OF.replace(year=2024), "2024-01-01", "2024-02-11")
    return failed_chunks(_checked_bars(spark, folder).bad, plan)


def landing_news(spark, folder):
    articles = views.news(spark, folder)
    insight = F.struct(
        F.col("sentiment_score").alias("score"),
        F.col("sentiment_label").alias("sentiment"),
        F.col("author").alias("sentiment_reasoning"),
    )
    records = articles.select(
        "id",
        "ticker",
        F.when(F.col("type") != "en", F.col("title")).alias("title"),
        "description",
        F.lit(None).cast("string").alias("article_url"),
        "author",
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_utc"),
        F.when(F.col("type") == "en", F.array()).otherwise(F.col("tickers")).alias("tickers"),
        F.when(F.col("type") != "en", F.col("keywords")).alias("keywords"),
        F.when(F.col("sentiment_label").isNotNull(), F.array(insight)).alias("insights"),
    )
    out = news_from_landing(_landing_json(records, LANDING_NEWS))
    sized = {"tickers": F.array_join("tickers", "|"), "keywords": F.size("keywords"), "description": F.length("description")}
    return shown(out.withColumns(sized))


def upsert_bars(spark, folder):
    bars = views.bars_daily(spark, folder)
    base = bars.filter(F.col("date") < "2000-01-01")
    batch = bars.filter(F.col("date") >= "1999-06-01").withColumn("close", F.col("close") * 1.01)
    return shown(merge_batch(base, batch, DAILY_POLICY))


def _changed_news(articles):
    return articles.withColumns(
        {
            "ticker": F.lit("NEW"),
            "author": F.lit("NEW"),
            "title": F.concat(F.lit("NEW "), "title"),
            "description": F.concat("description", F.lit(" (new)")),
            "keywords": F.reverse("keywords"),
            "tickers": F.array_append("tickers", F.lit("NEW")),
        }
    )


def upsert_news(spark, folder):
    articles = views.news(spark, folder)
    base = articles.filter(F.col("published_at") < "1995-03-15")
    batch = _changed_news(articles.filter(F.col("published_at") >= "1995-02-15"))
    merged = merge_batch(base, batch, NEWS_POLICY)
    listed = {"keywords": F.array_join("keywords", "|"), "tickers": F.array_join("tickers", "|")}
    return shown(merged.withColumns(listed))


def upsert_intraday(spark, folder):
    bars = views.bars_intraday(spark, folder)
    base = bars.filter(F.dayofmonth("timestamp") <= 20)
    batch = bars.filter(F.dayofmonth("timestamp") >= 10).withColumn("close", F.col("close") + 1)
    return shown(merge_batch(base, batch, INTRADAY_POLICY))


def _new_folder(spark):
    """A new folder that all executors reach; a local one only in a local session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/{uuid4().hex}"


def _stored(bars, path):
    bars.withColumn("month", month_of("date")).repartition("month").write.partitionBy("month").parquet(path)


def upsert_stored(spark, folder):
    bars, path = views.bars_daily(spark, folder), _new_folder(spark)
    _stored(bars.filter(F.col("date") < "2000-01-01"), path)
    batch = bars.filter(F.col("date").between("1999-11-15", "2000-02-15")).withColumns({"close": F.col("close") * 1.01, "month": month_of("date")})
    upsert_table(spark, path, batch, DAILY_POLICY)
    return shown(spark.read.parquet(path).drop("month"))


def news_loaded(spark, folder):
    listed = {"keywords": F.array_join("keywords", "|"), "tickers": F.array_join("tickers", "|")}
    return shown(load_news(views.news(spark, folder)).withColumns(listed))


def index_loaded(spark, folder):
    return shown(load_index(views.bars_daily(spark, folder), "1-URGENT"))


def news_blank(spark, folder):
    return shown(news.attach_news(views.bars_daily(spark, folder).select("ticker", "date"), None))


def news_per_ticker(spark, folder):
    rows = news_between(views.news(spark, folder), "1995-02-01", "1995-12-31", order="asc", per_ticker=3)
    return shown(rows.select("id", "ticker", "published_at"))


def daily_own_index(spark, folder):
    """Entry point of the daily plan, two tickers compared with a third."""
    symbols = spark.createDataFrame([(t, "3-MEDIUM") for t in ("1-URGENT", "2-HIGH")], "ticker string, market_index string")
    tables = MarketTables(views.bars_daily(spark, folder), symbols=symbols)
    return _keyed(prepare_daily_features(tables, ["1-URGENT", "2-HIGH"]).features, ("ticker", "date"), market.MARKET_COLUMNS)


def intraday_with_landed(spark, folder):
    """Entry point of the intraday plan, with bars fetched for the gaps."""
    tables = MarketTables(intraday=views.bars_intraday(spark, folder))
    done = prepare_intraday_features(tables, landed=_landed_for_gaps(spark, folder), expected_interval_minutes=30)
    return shown(done.features)


def saved_rows(spark, folder):
    """Rows of the saved feature tables, as counted while they were written."""
    symbols = spark.createDataFrame([(t, "3-MEDIUM") for t in ("1-URGENT", "2-HIGH")], "ticker string, market_index string")
    daily = prepare_daily_features(MarketTables(views.bars_daily(spark, folder), symbols=symbols), ["1-URGENT", "2-HIGH"], _new_folder(spark))
    intraday = prepare_intraday_features(MarketTables(intraday=views.bars_intraday(spark, folder)), None, _new_folder(spark))
    return spark.createDataFrame([("daily", daily.rows), ("intraday", intraday.rows)], "kind string, saved_rows long")


def export_daily(spark, folder):
    """Exported daily features read back."""
    symbols = spark.createDataFrame([(t, "3-MEDIUM") for t in ("1-URGENT", "2-HIGH")], "ticker string, market_index string")
    tables = MarketTables(views.bars_daily(spark, folder), symbols=symbols)
    path = export_features_to_parquet(tables, "daily", _new_folder(spark), ["1-URGENT", "2-HIGH"])
    return _keyed(spark.read.parquet(path), ("ticker", "date"), market.MARKET_COLUMNS)


def export_intraday(spark, folder):
    """Exported intraday features read back."""
    tables = MarketTables(intraday=views.bars_intraday(spark, folder))
    options = {"landed": _landed_for_gaps(spark, folder), "expected_interval_minutes": 30}
    return shown(spark.read.parquet(export_features_to_parquet(tables, "intraday", _new_folder(spark), **options)))


def export_news(spark, folder):
    """Exported news read back."""
    path = export_features_to_parquet(MarketTables(news=views.news(spark, folder)), "news", _new_folder(spark))
    listed = {"keywords": F.array_join("keywords", "|"), "tickers": F.array_join("tickers", "|")}
    return shown(spark.read.parquet(path).withColumns(listed))


def _ledger(spark, folder):
    """One ledger row per order."""
    orders = views.table(spark, folder, "orders")
    kind = (
        F.when(F.col("o_orderstatus") == "F", "daily").when(F.col("o_orderstatus") == "O", "intraday").otherwise("news")
    )
    day = F.to_date("o_orderdate")
    return orders.select(
        F.col("o_orderpriority").alias("ticker"),
        kind.alias("data_type"),
        day.alias("last_fetch_date"),
        F.when(F.col("o_totalprice") < 100000, "failed").otherwise("completed").alias("status"),
        F.timestamp_seconds(F.unix_date(day).cast("long") * 86400 + F.col("o_orderkey")).alias("updated_at"),
    )


def ledger_latest(spark, folder):
    return last_fetch(_ledger(spark, folder))


def _tickers(spark, folder):
    symbols = views.table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("ticker"), F.lit("SPY").alias("market_index")
    )
    return backfill_tickers(symbols.distinct())


def backfill_ranges(spark, folder):
    return resolve_date_ranges(
        _tickers(spark, folder), _ledger(spark, folder), "daily", "resume", AS_OF, lookback_days=60
    )


def backfill_plan_query(spark, folder):
    tickers, ledger = _tickers(spark, folder), _ledger(spark, folder)
    plans = [
        backfill_plan(tickers, ledger, kind, "resume", AS_OF, lookback_days=60).withColumn("plan", F.lit(f"{kind}_resume"))
        for kind in ("daily", "intraday", "news")
    ]
    plans.append(
        backfill_plan(tickers, None, "news", "full", AS_OF, "2001-06-01", "2001-07-05").withColumn("plan", F.lit("news_full"))
    )
    out = plans[0]
    for other in plans[1:]:
        out = out.unionByName(other)
    return out


def _applied(spark, folder):
    bars = views.bars_daily(spark, folder)
    base = bars.filter(F.col("date") < "2000-02-01")
    landed = bars.filter(F.col("date") >= "2000-01-01").withColumn("close", F.col("close") + 1)
    plan = backfill_plan(_tickers(spark, folder), None, "daily", "full", AS_OF, "2000-01-10", "2000-03-31")
    failures = plan.filter(F.col("ticker") == "5-LOW").withColumn("error_message", F.lit("timeout"))
    at = F.lit("2001-08-15 00:00:00").cast("timestamp")
    return apply_backfill(base, landed, plan, "daily", failures, at)


def _applied_stored(spark, folder):
    bars, root = views.bars_daily(spark, folder), _new_folder(spark)
    _stored(bars.filter(F.col("date") < "2000-02-01"), f"{root}/table")
    landed = bars.filter(F.col("date") >= "2000-01-01").withColumn("close", F.col("close") + 1)
    plan = backfill_plan(_tickers(spark, folder), None, "daily", "full", AS_OF, "2000-01-10", "2000-03-31")
    failures = plan.filter(F.col("ticker") == "5-LOW").withColumn("error_message", F.lit("timeout"))
    at = F.lit("2001-08-15 00:00:00").cast("timestamp")
    store_backfill(spark, f"{root}/table", f"{root}/ledger", landed, plan, "daily", failures, at)
    return root


def backfill_stored_table(spark, folder):
    return shown(spark.read.parquet(f"{_applied_stored(spark, folder)}/table").drop("month"))


def backfill_stored_ledger(spark, folder):
    return shown(spark.read.parquet(f"{_applied_stored(spark, folder)}/ledger"))


def upsert_news_stored(spark, folder):
    """The news merge into a stored table; the batch dates known articles to other months, which must not move them."""
    articles, path = views.news(spark, folder), _new_folder(spark)
    cut = F.lit("1995-03-15").cast("timestamp")
    base = articles.filter(F.col("published_at") < cut).withColumn("month", month_of("published_at"))
    base.repartition("month").write.partitionBy("month").parquet(f"{path}/table")
    index = KeyIndex(f"{path}/index", NEWS_POLICY.key, buckets=16)
    index.build(base)
    batch = _changed_news(articles.filter(F.col("published_at") >= "1995-02-15"))
    moved = F.when(F.col("published_at") < cut, F.col("published_at") + F.expr("INTERVAL 40 DAYS")).otherwise(F.col("published_at"))
    batch = batch.withColumn("published_at", moved).withColumn("month", month_of("published_at"))
    upsert_table(spark, f"{path}/table", batch, NEWS_POLICY, index=index)
    listed = {"keywords": F.array_join("keywords", "|"), "tickers": F.array_join("tickers", "|")}
    return shown(spark.read.parquet(f"{path}/table").drop("month").withColumns(listed))


def _stored_run(spark, base, landed, plan, kind, failing, index=None):
    """Folder of a stored backfill that is attempted twice."""
    root = _new_folder(spark)
    time = {"intraday": "timestamp", "news": "published_at"}[kind]
    base = base.withColumn("month", month_of(time))
    base.repartition("month").write.partitionBy("month").parquet(f"{root}/table")
    if index:
        index = KeyIndex(f"{root}/index", NEWS_POLICY.key, buckets=16)
        index.build(base)
    failures = plan.filter(F.col("ticker") == failing).withColumn("error_message", F.lit("timeout"))
    at = F.lit("2001-08-15 00:00:00").cast("timestamp")
    for _ in range(2):
        store_backfill(spark, f"{root}/table", f"{root}/ledger", landed, plan, kind, failures, at, batch_id="load-1", index=index)
    return root


def _news_run(spark, folder):
    articles = views.news(spark, folder)
    landed = articles.filter(F.col("published_at") >= "1995-01-15").withColumn("title", F.concat(F.lit("NEW "), "title"))
    plan = backfill_plan(_tickers(spark, folder), None, "news", "full", AS_OF, "1995-02-01", "1995-03-14")
    return _stored_run(spark, articles.filter(F.col("published_at") < "1995-02-20"), landed, plan, "news", "5-LOW", index=True)


def backfill_stored_news(spark, folder):
    return shown(spark.read.parquet(f"{_news_run(spark, folder)}/table").select("id", "ticker", "published_at", "title"))


def backfill_stored_news_ledger(spark, folder):
    return shown(spark.read.parquet(f"{_news_run(spark, folder)}/ledger"))


def backfill_stored_intraday(spark, folder):
    bars = views.bars_intraday(spark, folder)
    landed = bars.filter(F.col("timestamp") >= "2024-01-05").withColumn("close", F.col("close") + 1)
    plan = backfill_plan(bars.select("ticker").distinct(), None, "intraday", "full", AS_OF.replace(year=2024), "2024-01-10", "2024-01-20")
    root = _stored_run(spark, bars.filter(F.col("timestamp") < "2024-01-15"), landed, plan, "intraday", "click")
    return shown(spark.read.parquet(f"{root}/table").drop("month"))


def backfill_table(spark, folder):
    return shown(_applied(spark, folder).table)


def backfill_ledger(spark, folder):
    return shown(_applied(spark, folder).ledger)


QUERIES: dict[str, Query] = {
    "bars_daily": bars_daily,
    "bars_intraday": bars_intraday,
    "loaded_daily": loaded_daily,
    "loaded_intraday": loaded_intraday,
    "returns": _daily(price.Returns(P)),
    "volatility_sharpe": _daily(price.Returns(P), price.Risk(P), names=price.Risk(P).columns()),
    "max_drawdown": _daily(price.Drawdown(P)),
    "sma_ratios": _daily(price.SimpleAverages(P.sma_windows)),
    "ema": _daily(price.ExponentialAverages(P.ema_windows)),
    "price_range_position": _daily(price.RangePosition(P.price_position_windows)),
    "long_range_position": _daily(price.RangePosition((100, 1000))),
    "long_drawdown": _daily(price.Drawdown(PriceFeatureConfig(volatility_windows=(250,)))),
    "sparse_long_drawdown": _sparse(price.Drawdown(PriceFeatureConfig(volatility_windows=(250,)))),
    "true_range": _daily(price.TrueRange(P.true_range_window)),
    "volume_ratio_flags": _daily(volume.VolumeRatio(V)),
    "volume_trend": _daily(volume.VolumeTrend(V)),
    "dollar_volume": _daily(volume.TradedValue(V)),
    "sparse_ema": _sparse(price.ExponentialAverages((12,))),
    "sparse_macd": _sparse(technical.Macd(12, 26, 9)),
    "sparse_rsi": _sparse(technical.Rsi(14)),
    "sparse_atr": _sparse(technical.AverageTrueRange(14), names=["atr_14"]),
    "sparse_adx": _sparse(technical.Adx(14), names=["adx_14"]),
    "sparse_drawdown": _sparse(price.Drawdown(P)),
    "rsi": _daily(technical.Rsi(14)),
    "macd": _daily(technical.Macd(12, 26, 9)),
    "stochastic": _daily(technical.Stochastic(14, 3, 3)),
    "bollinger": _daily(technical.Bollinger(20, 2.0)),
    "atr": _daily(technical.AverageTrueRange(14)),
    "atr_simple": _daily(technical.AverageTrueRange(14, "sma"), names=["atr_14", "atr_pct_14"]),
    "adx": _daily(technical.Adx(14)),
    "ema_seeded": _daily(technical.SeededEma(14)),
    "wma": _daily(technical.LinearAverages(14, 14)),
    "market_relative": market_relative,
    "beta": beta,
    "confluence_flags": confluence_flags,
    "confluence_scores": confluence_scores,
    "daily_features": daily_features,
    "daily_features_with_news": daily_features_with_news,
    "feature_row_counts": feature_row_counts,
    "candle_shape": candle_shape,
    "candle_patterns": candle_patterns,
    "candle_momentum": candle_momentum,
    "session_clock": session_clock,
    "market_hours": market_hours,
    "intraday_volume": intraday_volume,
    "neighbor_flags": neighbor_flags,
    "intraday_features": intraday_features,
    "intraday_daily_rollup": intraday_daily_rollup,
    "daily_gaps": daily_gaps,
    "intraday_gaps": intraday_gaps,
    "missing_timestamps": missing_timestamps,
    "gap_ranges": gap_ranges,
    "gap_summary": gap_summary,
    "gap_fill": gap_fill,
    "gap_fill_summary": gap_fill_summary,
    "gap_fill_stored": gap_fill_stored,
    "gap_fill_remaining": gap_fill_remaining,
    "news_daily": news_daily,
    "news_rolling": news_rolling,
    "news_trend": news_trend,
    "news_attached": news_attached,
    "news_latest": news_latest,
    "lexicon_sentiment": lexicon_sentiment,
    "combined_sentiment": combined_sentiment,
    "landing_bars": landing_bars,
    "landing_news": landing_news,
    "landing_quarantine": landing_quarantine,
    "landing_failed_chunks": landing_failed_chunks,
    "upsert_bars": upsert_bars,
    "upsert_news": upsert_news,
    "ledger_latest": ledger_latest,
    "backfill_ranges": backfill_ranges,
    "backfill_plan": backfill_plan_query,
    "backfill_table": backfill_table,
    "backfill_ledger": backfill_ledger,
    "backfill_stored_table": backfill_stored_table,
    "backfill_stored_ledger": backfill_stored_ledger,
    "upsert_news_stored": upsert_news_stored,
    "backfill_stored_news": backfill_stored_news,
    "backfill_stored_news_ledger": backfill_stored_news_ledger,
    "backfill_stored_intraday": backfill_stored_intraday,
    "upsert_intraday": upsert_intraday,
    "upsert_stored": upsert_stored,
    "news_loaded": news_loaded,
    "index_loaded": index_loaded,
    "news_blank": news_blank,
    "news_per_ticker": news_per_ticker,
    "daily_own_index": daily_own_index,
    "intraday_with_landed": intraday_with_landed,
    "saved_rows": saved_rows,
    "export_daily": export_daily,
    "export_intraday": export_intraday,
    "export_news": export_news,
}
