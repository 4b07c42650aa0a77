"""Candlestick shapes, momentum and patterns of intraday bars.

Patterns look at bars of the same ticker only; a condition on a bar that does
not exist counts as not met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import divide, flag, q, require_columns
from .panel import Block, Panel, run_blocks

REQUIRED = ("ticker", "open", "high", "low", "close")
LOOKBACK = 10
# Share of the bar's range below which close counts as at its high or low.
NEAR_EDGE = 0.05


class EarlierBars(Block):
    """The few values of earlier bars that the row-wise columns below need."""

    lookback = LOOKBACK

    def first(self, panel: Panel) -> dict[str, str]:
        side = "signum(close - open)"
        return {
            "_close_1": panel.lag("close", 1),
            "_close_5": panel.lag("close", 5),
            "_close_10": panel.lag("close", 10),
            "_open_1": panel.lag("open", 1),
            "_side_1": panel.lag(side, 1),
            "_side_2": panel.lag(side, 2),
        }

    def columns(self) -> list[str]:
        return ["_close_1", "_close_5", "_close_10", "_open_1", "_side_1", "_side_2"]


def shape_columns() -> dict[str, Column]:
    o, h, l, c = (F.col(n) for n in ("open", "high", "low", "close"))
    body, spread = F.abs(c - o), h - l
    upper, lower = h - F.greatest(c, o), F.least(c, o) - l
    return {
        "body_size": body,
        "body_size_pct": divide(body, spread),
        "shadow_upper": upper,
        "shadow_lower": lower,
        "shadow_upper_pct": divide(upper, spread),
        "shadow_lower_pct": divide(lower, spread),
        "bullish": flag(c > o),
        "bearish": flag(c < o),
    }


def momentum_columns() -> dict[str, Column]:
    """Relative change over 1, 5 and 10 bars."""
    close = F.col("close")
    return {
        "price_change": divide(close, F.col("_close_1")) - 1,
        "price_change_5m": divide(close, F.col("_close_5")) - 1,
        "price_change_10m": divide(close, F.col("_close_10")) - 1,
    }


def pattern_columns() -> dict[str, Column]:
    o, h, l, c = (F.col(n) for n in ("open", "high", "low", "close"))
    up, down, still = c > o, c < o, c == o
    up_1, down_1 = F.col("_side_1") > 0, F.col("_side_1") < 0
    up_2, down_2 = F.col("_side_2") > 0, F.col("_side_2") < 0
    at_high = h - c < (h - l) * NEAR_EDGE
    at_low = c - l < (h - l) * NEAR_EDGE
    rules = {
        "is_bullish_engulfing": up & down_1,
        "is_bearish_engulfing": down & up_1,
        "is_hammer": down & at_high,
        "is_inverted_hammer": up & at_low,
        "is_shooting_star": down & at_low,
        "is_hanging_man": down & at_low,
        "is_bullish_morning_star": up & down_1 & up_2,
        "is_bearish_evening_star": down & up_1 & down_2,
        "is_dragonfly_doji": still & at_high,
        "is_gravestone_doji": still & at_low,
        "is_long_legged_doji": still & at_high,
        "is_piercing_pattern": down & up_1 & (c > F.col("_open_1")),
        "is_dark_cloud_cover": up & down_1 & (c < F.col("_open_1")),
        "is_three_black_crows": down & down_1 & down_2,
        "is_three_white_soldiers": up & up_1 & up_2,
    }
    return {name: flag(rule) for name, rule in rules.items()}


def range_columns() -> dict[str, Column]:
    spread = F.col("high") - F.col("low")
    return {"price_range": spread, "price_range_pct": divide(spread, spread)}


def candle_columns() -> dict[str, Column]:
    """All candlestick columns; needs those of :class:`EarlierBars`."""
    return shape_columns() | momentum_columns() | pattern_columns() | range_columns()


def candle_features(df: DataFrame, order: str = "timestamp") -> DataFrame:
    """All candlestick columns for a table of bars."""
    require_columns(df, (*REQUIRED, order), "candle_features")
    return run_blocks(df, EarlierBars(), order=order).select(
        *[q(c) for c in df.columns], *[e.alias(n) for n, e in candle_columns().items()]
    )


def intraday_rollup(candles: DataFrame) -> DataFrame:
    """Pattern counts and session activity per ticker and local day; needs the
    candlestick and clock columns and ``local_date``."""
    return candles.groupBy("ticker", F.col("local_date").alias("date")).agg(
        F.sum("is_hammer").alias("hammer_count"),
        F.sum("is_bullish_engulfing").alias("bullish_engulf_count"),
        F.sum("is_bearish_engulfing").alias("bearish_engulf_count"),
        F.sum("is_opening_window").alias("opening_activity"),
        F.sum("is_closing_window").alias("closing_activity"),
        F.avg("body_size_pct").alias("avg_body_size"),
        F.max("price_range_pct").alias("max_range_pct"),
    )
