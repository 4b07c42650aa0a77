"""Daily news features per ticker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import NewsFeatureConfig
from ..functions.expressions import flag, require_columns
from .panel import Block, Panel, run_blocks

REQUIRED = ("ticker", "title", "description", "author", "type", "keywords", "tickers")

FLAT_SLOPE = 1e-12

COUNT_COLUMNS = (
    "news_count",
    "news_rolling_count",
    "unique_authors",
    "unique_types",
    "total_keywords",
    "total_related_tickers",
    "positive_count",
    "negative_count",
    "neutral_count",
)
NUMERIC_COLUMNS = (
    "avg_title_length",
    "avg_description_length",
    "sentiment_score_mean",
    "sentiment_score_std",
    "sentiment_rolling_avg",
    "sentiment_trend",
)
NEWS_COLUMNS = (
    "news_count",
    "avg_title_length",
    "avg_description_length",
    "unique_authors",
    "unique_types",
    "total_keywords",
    "total_related_tickers",
    "sentiment_score_mean",
    "sentiment_score_std",
    "positive_count",
    "negative_count",
    "neutral_count",
    "news_rolling_count",
    "sentiment_rolling_avg",
    "sentiment_trend",
)


def _length(name: str) -> Column:
    return F.length(F.coalesce(F.col(name), F.lit("")))


def _items(name: str) -> Column:
    return F.coalesce(F.size(F.col(name)), F.lit(0))


def news_daily(news: DataFrame, config: NewsFeatureConfig | None = None) -> DataFrame:
    """One row per ticker and UTC day with news.

    The texts are reduced to their lengths before the shuffle, and every
    aggregate is first taken per input partition, so a busy day stays small.
    """
    cfg = config or NewsFeatureConfig()
    require_columns(news, REQUIRED, "news_daily")
    day = F.to_date("published_at" if "published_at" in news.columns else "date")
    label = F.col("sentiment_label") if "sentiment_label" in news.columns else F.lit(None).cast("string")
    score = F.col("sentiment_score") if "sentiment_score" in news.columns else F.lit(None)
    slim = news.select(
        "ticker",
        day.alias("date"),
        "author",
        "type",
        _length("title").alias("_title"),
        _length("description").alias("_description"),
        _items("keywords").alias("_keywords"),
        _items("tickers").alias("_tickers"),
        score.cast("double").alias("_score"),
        *[flag(label == side).alias(f"_{side}") for side in ("positive", "negative", "neutral")],
    )
    return slim.groupBy("ticker", "date").agg(
        F.count("ticker").alias("news_count"),
        F.avg("_title").alias("avg_title_length"),
        F.avg("_description").alias("avg_description_length"),
        F.count_distinct("author").alias("unique_authors"),
        F.count_distinct("type").alias("unique_types"),
        F.sum("_keywords").alias("total_keywords"),
        F.sum("_tickers").alias("total_related_tickers"),
        F.avg("_score").alias("sentiment_score_mean"),
        F.coalesce(F.stddev_samp("_score"), F.lit(cfg.fill_numeric)).alias("sentiment_score_std"),
        F.sum("_positive").alias("positive_count"),
        F.sum("_negative").alias("negative_count"),
        F.sum("_neutral").alias("neutral_count"),
    )


class NewsRolling(Block):
    """Rolling count, average score and score trend over days that have news."""

    def __init__(self, cfg: NewsFeatureConfig):
        self.cfg = cfg
        self.lookback = cfg.lookback_days

    def first(self, panel: Panel) -> dict[str, str]:
        score, recent = "sentiment_score_mean", panel.frame(self.cfg.lookback_days)
        return {
            # Numbers the days that have a score, so days without one leave no step.
            "_scored": f"CAST(count({score}) OVER ({panel.so_far}) AS DOUBLE)",
            "_points": f"count({score}) OVER ({recent})",
            "news_rolling_count": f"sum(news_count) OVER ({recent})",
            "sentiment_rolling_avg": f"avg({score}) OVER ({recent})",
        }

    def second(self, panel: Panel) -> dict[str, str]:
        recent = panel.frame(self.cfg.lookback_days)
        return {"_slope": f"regr_slope(sentiment_score_mean, _scored) OVER ({recent})"}

    def rows(self) -> list[dict[str, str]]:
        # Enough periods but a single point is a flat line, not a missing one; so is
        # a slope that is only the rounding of equal scores.
        enough = f"_points >= {self.cfg.trend_min_periods}"
        sloped = f"_points >= 2 AND abs(_slope) >= {FLAT_SLOPE!r}D"
        return [
            {
                "sentiment_trend": f"CASE WHEN {enough} AND {sloped} THEN _slope "
                f"WHEN {enough} THEN 0D ELSE {float(self.cfg.fill_numeric)!r}D END"
            }
        ]

    def columns(self) -> list[str]:
        return ["news_rolling_count", "sentiment_rolling_avg", "sentiment_trend"]


def news_rolling(daily_news: DataFrame, config: NewsFeatureConfig | None = None) -> DataFrame:
    """Add rolling columns; the window counts days that have news."""
    return run_blocks(daily_news, NewsRolling(config or NewsFeatureConfig()))


def attach_news(bars: DataFrame, news: DataFrame | None, config: NewsFeatureConfig | None = None) -> DataFrame:
    """Join the news columns to daily bars; days without news get the fill values.
    Without a news table every row gets them."""
    cfg = config or NewsFeatureConfig()
    fill = dict.fromkeys(COUNT_COLUMNS, cfg.fill_count) | dict.fromkeys(NUMERIC_COLUMNS, cfg.fill_numeric)
    if news is None:
        typed = {c: F.lit(fill[c]).cast("long" if c in COUNT_COLUMNS else "double") for c in NEWS_COLUMNS}
        return bars.withColumns(typed)
    features = news_rolling(news_daily(news, cfg), cfg).select("ticker", "date", *NEWS_COLUMNS)
    return bars.join(features, ["ticker", "date"], "left").fillna(fill)
