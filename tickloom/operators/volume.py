"""Volume features: averages, ratios, trends, traded value."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import VolumeFeatureConfig
from ..functions.expressions import guarded, require_columns
from .panel import Block, Panel, run_blocks

REQUIRED = ("ticker", "close", "volume")
TRADED_VALUE_WINDOW = 20


class VolumeRatio(Block):
    """Volume against its average, with spike and dry flags."""

    def __init__(self, cfg: VolumeFeatureConfig):
        self.cfg = cfg
        self.windows = tuple(dict.fromkeys((*cfg.volume_windows, cfg.ratio_baseline_window)))
        self.lookback = max(self.windows)

    def first(self, panel: Panel) -> dict[str, str]:
        return {f"volume_sma_{n}": panel.mean("volume", n) for n in self.windows}

    def rows(self) -> list[dict[str, str]]:
        cfg = self.cfg
        return [
            {"volume_ratio": f"volume / {guarded(f'volume_sma_{cfg.ratio_baseline_window}')}"},
            {
                "volume_spike": f"CASE WHEN volume_ratio > {cfg.spike_threshold!r}D THEN 1 ELSE 0 END",
                "volume_dry": f"CASE WHEN volume_ratio < {cfg.dry_threshold!r}D THEN 1 ELSE 0 END",
            },
        ]

    def columns(self) -> list[str]:
        return [f"volume_sma_{n}" for n in self.windows] + ["volume_ratio", "volume_spike", "volume_dry"]


class VolumeTrend(Block):
    """Least-squares slope of the volume."""

    def __init__(self, cfg: VolumeFeatureConfig):
        self.windows = cfg.trend_windows
        self.lookback = max(self.windows)

    def first(self, panel: Panel) -> dict[str, str]:
        return {f"volume_trend_{n}d": panel.whole_number_slope("volume", n) for n in self.windows}

    def columns(self) -> list[str]:
        return [f"volume_trend_{n}d" for n in self.windows]


class TradedValue(Block):
    """Traded value and its averages. ``liquidity`` adds the product of the two
    separate averages and the average of the product, which differ."""

    def __init__(self, cfg: VolumeFeatureConfig, liquidity: bool = True):
        self.windows = cfg.volume_windows if liquidity else ()
        self.lookback = max(TRADED_VALUE_WINDOW, *self.windows, 1)

    def first(self, panel: Panel) -> dict[str, str]:
        def mean_value(n: int) -> str:
            return panel.full(n, f"avg(close * volume) OVER ({panel.frame(n)})", "close", "volume")

        out = {
            "price_volume": "close * volume",
            f"price_volume_sma_{TRADED_VALUE_WINDOW}": mean_value(TRADED_VALUE_WINDOW),
        }
        for n in self.windows:
            out |= {f"_close_mean_{n}": panel.mean("close", n), f"_volume_mean_{n}": panel.mean("volume", n)}
            out[f"avg_dollar_volume_{n}d"] = mean_value(n)
        return out

    def rows(self) -> list[dict[str, str]]:
        return [{f"liquidity_{n}d": f"_close_mean_{n} * _volume_mean_{n}" for n in self.windows}]

    def columns(self) -> list[str]:
        averages = [name for n in self.windows for name in (f"liquidity_{n}d", f"avg_dollar_volume_{n}d")]
        return ["price_volume", f"price_volume_sma_{TRADED_VALUE_WINDOW}", *averages]


def volume_blocks(cfg: VolumeFeatureConfig, liquidity: bool = True) -> tuple[Block, ...]:
    return VolumeRatio(cfg), VolumeTrend(cfg), TradedValue(cfg, liquidity)


def volume_features(df: DataFrame, config: VolumeFeatureConfig | None = None, order: str = "date") -> DataFrame:
    """All volume columns; windows run in the order of ``order`` within a ticker."""
    require_columns(df, (*REQUIRED, order), "volume_features")
    return run_blocks(df, *volume_blocks(config or VolumeFeatureConfig()), order=order)
