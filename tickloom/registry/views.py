"""Bars, news and landing records derived from the sample tables.

The sample tables hold no market data, so each query reads one of these views.
They are defined the same way in SQL on the checking side.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare_session


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def _ohlc(value: str, order: str) -> list[Column]:
    return [
        F.min_by(value, order).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, order).alias("close"),
    ]


# Prices are decimals at rest; their sums are exact whatever the order.
PRICE = "decimal(12,4)"


def _exact_sum(value: Column) -> Column:
    return F.sum(value).cast("double")


def _weighted_mean(value: str, weight: Column) -> Column:
    total = _exact_sum(F.col(value).cast(PRICE) * weight)
    return (total / F.sum(weight)).alias("volume_weighted_avg_price")


def bars_daily(spark: SparkSession, folder: str) -> DataFrame:
    """One bar per order priority and order date."""
    weight = F.col("o_custkey") + 1
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias("ticker"), F.to_date("o_orderdate").alias("date"))
        .agg(
            *_ohlc("o_totalprice", "o_orderkey"),
            F.sum(weight).alias("volume"),
            F.count(F.lit(1)).alias("transactions"),
            _weighted_mean("o_totalprice", weight),
        )
    )


def index_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Mean order price per date, standing in for the market index."""
    return (
        table(spark, folder, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg((_exact_sum(F.col("o_totalprice").cast(PRICE)) / F.count(F.lit(1))).alias("close"))
    )


def bars_intraday(spark: SparkSession, folder: str) -> DataFrame:
    """30-minute bars per event type."""
    at = F.col("ts").cast("timestamp")
    slot = F.timestamp_seconds(F.floor(F.unix_seconds(at) / 1800) * 1800)
    weight = F.col("user_id") + 1
    return (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("ticker"), slot.alias("timestamp"))
        .agg(
            *_ohlc("value", "ts"),
            F.sum(weight).alias("volume"),
            F.count(F.lit(1)).alias("transactions"),
            _weighted_mean("value", weight),
        )
    )


def bars_event_days(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars of the same instruments as the 30-minute bars."""
    weight = F.col("user_id") + 1
    return (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("ticker"), F.to_date("ts").alias("date"))
        .agg(
            *_ohlc("value", "ts"),
            F.sum(weight).alias("volume"),
            F.count(F.lit(1)).alias("transactions"),
            _weighted_mean("value", weight),
        )
    )


# Tickers of the daily view, by remainder of the document id.
TICKERS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def news(spark: SparkSession, folder: str) -> DataFrame:
    """One article per document, with the labels as vendor sentiment."""
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id", "quality", "toxic")
    ticker = F.element_at(F.array(*[F.lit(t) for t in TICKERS]), (F.col("doc_id") % 5 + 1).cast("int"))
    day = F.date_add(F.lit("1995-01-02").cast("date"), F.floor(F.col("doc_id") / 10).cast("int"))
    published = F.timestamp_seconds(F.unix_date(day).cast("long") * 86400 + F.col("doc_id") % 24 * 3600)
    labelled = F.col("toxic").isNotNull()
    score = (
        F.when(F.col("toxic") == 1, F.lit(-0.8))
        .when(F.col("quality") == 1, F.lit(0.5))
        .when(labelled, F.lit(0.0))
    )
    label = (
        F.when(F.col("toxic") == 1, F.lit("negative"))
        .when(F.col("quality") == 1, F.lit("positive"))
        .when(labelled, F.lit("neutral"))
    )
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("id"),
        ticker.alias("ticker"),
        published.alias("published_at"),
        F.split("text", "\n").getItem(0).alias("title"),
        F.col("text").alias("description"),
        F.lit("").alias("url"),
        F.col("source").alias("author"),
        F.col("lang").alias("type"),
        score.alias("sentiment_score"),
        label.alias("sentiment_label"),
        F.lit(None).cast("string").alias("sentiment_reasoning"),
        F.split("text", " ").alias("keywords"),
        F.array("source").alias("tickers"),
    )
