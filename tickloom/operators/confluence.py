"""Row-wise confirmation flags and the weighted bullish and bearish scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ConfluenceConfig, PriceFeatureConfig, TechnicalIndicatorConfig
from ..functions.expressions import column_or, first_with_prefix, flag, q

CONFLUENCE_COLUMNS = (
    "vol_confirm_primary",
    "vol_confirm_secondary",
    "vol_trend_up",
    "momentum_rsi_confirm",
    "momentum_macd_cross",
    "trend_price_above_sma20",
    "trend_price_above_sma50",
    "trend_strong_adx",
    "bb_reentry_signal",
    "atr_breakout",
    "near_high_volume_node",
    "near_range_extreme",
    "news_sentiment_positive",
    "news_sentiment_trending_up",
    "pattern_strength",
    "bullish_confluence_score",
    "bearish_confluence_score",
)


@dataclass(frozen=True)
class SignalNames:
    """Columns the flags read."""

    rsi: str
    macd: str
    macd_signal: str
    macd_hist: str
    average_range: str
    sentiment: str

    @classmethod
    def resolve(
        cls, cfg: ConfluenceConfig, price: PriceFeatureConfig, technical: TechnicalIndicatorConfig
    ) -> SignalNames:
        if cfg.compat:
            return cls("rsi_14", "macd", "macd_signal", "macd_histogram", "avg_true_range_14", "sentiment_mean")
        macd = f"{technical.macd_fast}_{technical.macd_slow}_{technical.macd_signal}"
        return cls(
            f"rsi_{technical.rsi_length}",
            f"macd_{macd}",
            f"macd_signal_{macd}",
            f"macd_hist_{macd}",
            f"avg_true_range_{price.true_range_window}",
            "sentiment_score_mean",
        )


def _weighted(weights: dict[str, float], parts: dict[str, Column]) -> Column:
    terms = [F.lit(float(weights.get(name, 0))) * part for name, part in parts.items()]
    return sum(terms[1:], terms[0])


def confluence_features(
    df: DataFrame,
    config: ConfluenceConfig | None = None,
    price_config: PriceFeatureConfig | None = None,
    technical_config: TechnicalIndicatorConfig | None = None,
) -> DataFrame:
    """Add the flags and scores. A signal whose column is absent counts as 0."""
    cfg = config or ConfluenceConfig()
    names = SignalNames.resolve(
        cfg, price_config or PriceFeatureConfig(), technical_config or TechnicalIndicatorConfig()
    )

    def signal(name: str) -> Column:
        return column_or(df, name, 0)

    ratio = signal("volume_ratio")
    above_20, above_50 = signal("close_vs_sma20") > 0, signal("close_vs_sma50") > 0
    rsi, change = signal(names.rsi), signal("price_change")
    reversal = ((rsi < cfg.rsi_oversold) & (change > 0)) | ((rsi > cfg.rsi_overbought) & (change < 0))
    cross = (signal(names.macd) > signal(names.macd_signal)) & (signal(names.macd_hist) > 0)
    band = first_with_prefix(df, "bb_pct_")
    reentry = (q(band) < 0) & above_20 if band else F.lit(False)
    average_range = column_or(df, names.average_range, None).cast("double")
    place = column_or(df, "price_vs_20d_range", None).cast("double")
    middle = place.between(cfg.price_range_midband_low, cfg.price_range_midband_high)
    extreme = (place <= cfg.price_range_extreme_low) | (place >= cfg.price_range_extreme_high)
    strength = signal("hammer_count") + signal("bullish_engulf_count") - signal("bearish_engulf_count")

    flagged = df.withColumns(
        {
            "vol_confirm_primary": flag(ratio >= cfg.volume_ratio_confirm),
            "vol_confirm_secondary": flag(ratio >= cfg.volume_ratio_high),
            "vol_trend_up": flag(signal("volume_trend_5d") > 0),
            "momentum_rsi_confirm": flag(reversal),
            "momentum_macd_cross": flag(cross),
            "trend_price_above_sma20": flag(above_20),
            "trend_price_above_sma50": flag(above_50),
            "trend_strong_adx": flag(signal("adx") > cfg.adx_trend_threshold),
            "bb_reentry_signal": flag(reentry),
            "atr_breakout": flag(signal("true_range") >= average_range * cfg.atr_breakout_multiplier),
            "near_high_volume_node": flag(middle & (ratio > 1)),
            "near_range_extreme": flag(extreme),
            "news_sentiment_positive": flag(signal(names.sentiment) > 0),
            "news_sentiment_trending_up": flag(signal("sentiment_trend") > 0),
            "pattern_strength": strength,
        }
    )
    strength = F.col("pattern_strength")
    shared = {
        "volume": F.col("vol_confirm_primary"),
        "rsi": F.col("momentum_rsi_confirm"),
    }
    rising, positive = F.col("trend_price_above_sma20"), F.col("news_sentiment_positive")
    return flagged.withColumns(
        {
            "bullish_confluence_score": _weighted(
                cfg.bullish_weights,
                shared
                | {
                    "macd": F.col("momentum_macd_cross"),
                    "trend": rising,
                    "bollinger": F.col("bb_reentry_signal"),
                    "news": positive,
                    "patterns": F.when(strength > 0, strength).when(strength <= 0, F.lit(0)),
                },
            ),
            "bearish_confluence_score": _weighted(
                cfg.bearish_weights,
                shared
                | {
                    "trend": 1 - rising,
                    "atr": F.col("atr_breakout"),
                    "news": 1 - positive,
                    "patterns": F.when(strength < 0, -strength).when(strength >= 0, F.lit(0)),
                },
            ),
        }
    )
