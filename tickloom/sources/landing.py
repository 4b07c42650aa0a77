"""Mapping of landed vendor records to the shape of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LANDING_BARS, LANDING_NEWS


def read_landing_bars(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDING_BARS).json(path)


def read_landing_news(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDING_NEWS).json(path)


def bars_from_landing(df: DataFrame, with_date: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Epoch milliseconds to a UTC timestamp (and date), short names to long; columns in ``keep`` stay."""
    at = F.timestamp_millis(F.col("timestamp"))
    out = df.select(
        "ticker",
        at.alias("timestamp"),
        *[F.col(n).cast("double").alias(n) for n in ("open", "high", "low", "close")],
        F.col("volume").cast("long").alias("volume"),
        F.col("transactions").cast("long").alias("transactions"),
        F.col("vwap").cast("double").alias("volume_weighted_avg_price"),
        *keep,
    )
    return out.withColumn("date", F.to_date("timestamp")) if with_date else out


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _filled(name: str, default: Column) -> Column:
    """The array unless it is missing or empty."""
    return F.when(F.size(F.coalesce(F.col(name), F.array())) > 0, F.col(name)).otherwise(default)


def news_from_landing(df: DataFrame, only_with_insights: bool = True) -> DataFrame:
    """Articles with the first insight as vendor sentiment."""
    insights = F.coalesce(F.size("insights"), F.lit(0))
    if only_with_insights:
        df = df.filter(insights > 0)
    first = F.when(insights > 0, F.get("insights", F.lit(0)))
    nothing = F.array().cast("array<string>")
    own = F.when(F.col("ticker").isNotNull(), F.array("ticker")).otherwise(nothing)
    return df.select(
        "id",
        "ticker",
        F.to_timestamp("published_utc").alias("published_at"),
        _text("title").alias("title"),
        _text("description").alias("description"),
        _text("article_url").alias("url"),
        _text("author").alias("author"),
        F.lit("article").alias("type"),
        first["score"].alias("sentiment_score"),
        first["sentiment"].alias("sentiment_label"),
        first["sentiment_reasoning"].alias("sentiment_reasoning"),
        _filled("tickers", own).alias("tickers"),
        _filled("keywords", nothing).alias("keywords"),
    )
