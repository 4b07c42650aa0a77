"""Readers of the bar, news and ledger tables."""

from __future__ import annotations

import os
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expressions import require_columns
from ..operators.panel import run_blocks
from ..operators.quality import DayDistance, SecondDistance, calendar_columns, daily_gaps, intraday_gaps

Tickers = str | Iterable[str] | None

STORED = ("daily_bars", "intraday_bars", "news_articles", "api_metadata", "symbols")
PRICES = ("open", "high", "low", "close")
TAIL = ("volume", "transactions", "volume_weighted_avg_price")
NEWS_COLUMNS = (
    "ticker",
    "published_at",
    "title",
    "description",
    "url",
    "author",
    "type",
    "keywords",
    "tickers",
    "sentiment_score",
    "sentiment_label",
    "sentiment_reasoning",
)


@dataclass(frozen=True)
class MarketTables:
    """The tables a plan reads; any may be absent."""

    daily: DataFrame | None = None
    intraday: DataFrame | None = None
    news: DataFrame | None = None
    ledger: DataFrame | None = None
    symbols: DataFrame | None = None

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> MarketTables:
        def read(name: str) -> DataFrame:
            return spark.read.parquet(os.path.join(root, name))

        return cls(*map(read, STORED))

    @classmethod
    def from_jdbc(
        cls, spark: SparkSession, url: str, partitioned: dict[str, dict[str, str]], **options: str
    ) -> MarketTables:
        """Tables of a database; filters and column lists are pushed to it.

        ``partitioned`` has the options of each table by which several tasks read it at
        once (partitionColumn, lowerBound, upperBound, numPartitions).
        """

        def read(name: str) -> DataFrame:
            own = options | partitioned.get(name, {})
            return spark.read.format("jdbc").options(url=url, dbtable=name, **own).load()

        return cls(*map(read, STORED))


def filter_tickers(df: DataFrame, ticker: Tickers) -> DataFrame:
    """All rows for None or an empty list, else those of the ticker or tickers."""
    if ticker is None:
        return df
    if isinstance(ticker, str):
        return df.filter(F.col("ticker") == ticker)
    if isinstance(ticker, Iterable):
        wanted = list(ticker)
        return df.filter(F.col("ticker").isin(wanted)) if wanted else df
    raise TypeError("ticker must be None, a string or an iterable of strings")


def _scan_bars(df: DataFrame, time: str, ticker: Tickers) -> DataFrame:
    require_columns(df, ("ticker", time, *PRICES, *TAIL), f"bars by {time}")
    return filter_tickers(df, ticker).select(
        "ticker",
        time,
        *[F.col(n).cast("double").alias(n) for n in PRICES],
        "volume",
        "transactions",
        F.col("volume_weighted_avg_price").cast("double").alias("volume_weighted_avg_price"),
    )


def scan_daily_bars(df: DataFrame, ticker: Tickers = None) -> DataFrame:
    """Nine columns of the daily bars, decimals as doubles."""
    return _scan_bars(df, "date", ticker)


def scan_intraday_bars(df: DataFrame, ticker: Tickers = None) -> DataFrame:
    return _scan_bars(df, "timestamp", ticker)


def load_daily_bars(df: DataFrame, ticker: Tickers = None) -> tuple[DataFrame, DataFrame]:
    """Daily bars with calendar columns, and their gaps."""
    bars = scan_daily_bars(df, ticker)
    loaded = run_blocks(bars, DayDistance()).withColumns(calendar_columns(F.col("date")))
    return loaded, daily_gaps(bars)


def load_intraday_bars(
    df: DataFrame, ticker: Tickers = None, expected_interval_minutes: int = 5
) -> tuple[DataFrame, DataFrame]:
    """Intraday bars with UTC date and calendar columns, and their gaps."""
    bars = scan_intraday_bars(df, ticker)
    at = F.col("timestamp")
    loaded = run_blocks(bars, SecondDistance(), order="timestamp").withColumns({"date": F.to_date(at)} | calendar_columns(at))
    return loaded, intraday_gaps(bars, expected_interval_minutes)


def load_news(df: DataFrame, ticker: Tickers = None) -> DataFrame:
    return filter_tickers(df, ticker).select(*[c for c in NEWS_COLUMNS])


def load_index(df: DataFrame, market_index: str) -> DataFrame:
    """Date and close of one index."""
    return df.filter(F.col("ticker") == market_index).select("date", F.col("close").cast("double").alias("close"))


def news_between(
    df: DataFrame,
    published_gte: str | None = None,
    published_lte: str | None = None,
    ticker: Tickers = None,
    order: str = "desc",
    limit: int | None = None,
    per_ticker: int | None = None,
) -> DataFrame:
    """Articles of a period, newest or oldest first: all, or on request the first
    ``limit`` of them, or the first ``per_ticker`` of each ticker."""
    if order not in ("asc", "desc"):
        raise ValueError("order must be 'asc' or 'desc'")
    out = filter_tickers(df, ticker)
    if published_gte is not None:
        out = out.filter(F.col("published_at") >= F.lit(published_gte).cast("timestamp"))
    if published_lte is not None:
        out = out.filter(F.col("published_at") <= F.lit(published_lte).cast("timestamp"))
    at = F.col("published_at")
    ordered = (at.asc() if order == "asc" else at.desc(), F.col("id"))
    if per_ticker is not None:
        rank = F.row_number().over(Window.partitionBy("ticker").orderBy(*ordered))
        out = out.withColumn("_rank", rank).filter(F.col("_rank") <= per_ticker).drop("_rank")
    out = out.orderBy(*ordered)
    return out if limit is None else out.limit(limit)
