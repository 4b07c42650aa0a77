"""Schemas of the tables at rest and of the landing files."""

from __future__ import annotations

from pyspark.sql import types as T

_PRICE = T.DecimalType(12, 4)
_STAMPS = [T.StructField("created_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType())]


def _bars(time: T.StructField) -> T.StructType:
    return T.StructType(
        [
            T.StructField("ticker", T.StringType(), False),
            time,
            *[T.StructField(n, _PRICE, False) for n in ("open", "high", "low", "close")],
            T.StructField("volume", T.LongType()),
            T.StructField("transactions", T.LongType()),
            T.StructField("volume_weighted_avg_price", _PRICE),
            *_STAMPS,
        ]
    )


DAILY_BARS = _bars(T.StructField("date", T.DateType(), False))
INTRADAY_BARS = _bars(T.StructField("timestamp", T.TimestampType(), False))

NEWS_ARTICLES = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("ticker", T.StringType(), False),
        T.StructField("published_at", T.TimestampType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("description", T.StringType(), False),
        T.StructField("url", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("sentiment_score", T.DecimalType(3, 2)),
        T.StructField("sentiment_label", T.StringType()),
        T.StructField("sentiment_reasoning", T.StringType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("tickers", T.ArrayType(T.StringType())),
        *_STAMPS,
    ]
)

DATA_TYPES = ("daily", "intraday", "news")
STATUSES = ("pending", "in_progress", "completed", "failed")

LEDGER = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("date_range_start", T.DateType()),
        T.StructField("date_range_end", T.DateType()),
        T.StructField("last_fetch_date", T.DateType()),
        T.StructField("last_success_date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("rows_inserted", T.IntegerType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

LANDING_BARS = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        *[T.StructField(n, T.DoubleType()) for n in ("open", "high", "low", "close")],
        T.StructField("volume", T.LongType()),
        T.StructField("transactions", T.LongType()),
        T.StructField("vwap", T.DoubleType()),
    ]
)

LANDING_NEWS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("article_url", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("published_utc", T.StringType()),
        T.StructField("tickers", T.ArrayType(T.StringType())),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField(
            "insights",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("score", T.DoubleType()),
                        T.StructField("sentiment", T.StringType()),
                        T.StructField("sentiment_reasoning", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)
