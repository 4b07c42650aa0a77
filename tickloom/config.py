"""Knobs of the feature blocks. Field names are part of the public surface and
window lengths appear in the output column names."""

from __future__ import annotations

from dataclasses import dataclass, field


# The names and defaults of all settings below are part of the interface.


@dataclass(frozen=True)
class PriceFeatureConfig:
    return_windows: tuple[int, ...] = (5, 10, 20)
    sma_windows: tuple[int, ...] = (5, 10, 20, 50, 200)
    ema_windows: tuple[int, ...] = (12, 26)
    volatility_windows: tuple[int, ...] = (5, 20)
    price_position_windows: tuple[int, ...] = (5, 20)
    true_range_window: int = 14
    keep_na: bool = False


@dataclass(frozen=True)
class VolumeFeatureConfig:
    volume_windows: tuple[int, ...] = (5, 20)
    trend_windows: tuple[int, ...] = (5, 20)
    ratio_baseline_window: int = 20
    spike_threshold: float = 2.0
    dry_threshold: float = 0.5


@dataclass(frozen=True)
class TechnicalIndicatorConfig:
    rsi_length: int = 14
    macd_fast: int = 12
    macd_slow: int = 26
    macd_signal: int = 9
    stochastic_k: int = 14
    stochastic_d: int = 3
    stochastic_smooth: int = 3
    bollinger_length: int = 20
    bollinger_std: float = 2.0
    bollinger_ddof: int = 1
    atr_length: int = 14
    atr_smoothing: str = "wilder"  # or "sma"
    adx_length: int = 14
    ema_length: int = 14
    sma_length: int = 14
    wma_length: int = 14


@dataclass(frozen=True)
class TimeFeatureConfig:
    market_open_hour: int = 9
    market_open_minute: int = 30
    market_close_hour: int = 16
    market_close_minute: int = 0
    opening_window_minutes: int = 30
    closing_window_minutes: int = 30
    lunch_hours: tuple[int, int] = (11, 14)
    morning_hours: tuple[int, int] = (9, 12)
    afternoon_hours: tuple[int, int] = (12, 16)
    session_timezone: str = "America/New_York"

    @property
    def open_minute_of_day(self) -> int:
        return self.market_open_hour * 60 + self.market_open_minute

    @property
    def close_minute_of_day(self) -> int:
        return self.market_close_hour * 60 + self.market_close_minute


@dataclass(frozen=True)
class NewsFeatureConfig:
    lookback_days: int = 7
    trend_min_periods: int = 2
    fill_numeric: float = 0.0
    fill_count: int = 0


# Default score weights.
BULLISH_WEIGHTS = {
    "volume": 0.3,
    "macd": 0.2,
    "trend": 0.2,
    "rsi": 0.1,
    "bollinger": 0.1,
    "news": 0.1,
    "patterns": 0.1,
}
BEARISH_WEIGHTS = {
    "volume": 0.3,
    "trend": 0.2,
    "rsi": 0.2,
    "atr": 0.1,
    "news": 0.1,
    "patterns": 0.1,
}


@dataclass(frozen=True)
class ConfluenceConfig:
    volume_ratio_confirm: float = 1.2
    volume_ratio_high: float = 1.5
    rsi_oversold: float = 30.0
    rsi_overbought: float = 70.0
    adx_trend_threshold: float = 20.0
    atr_breakout_multiplier: float = 1.2
    price_range_midband_low: float = 0.4
    price_range_midband_high: float = 0.6
    price_range_extreme_low: float = 0.1
    price_range_extreme_high: float = 0.9
    bullish_weights: dict[str, float] = field(default_factory=lambda: dict(BULLISH_WEIGHTS))
    bearish_weights: dict[str, float] = field(default_factory=lambda: dict(BEARISH_WEIGHTS))
    # True reads the signal columns by the literal names macd, macd_signal,
    # macd_histogram, sentiment_mean, rsi_14 and avg_true_range_14, absent ones
    # counting as their default, instead of the names the blocks produce.
    compat: bool = False
