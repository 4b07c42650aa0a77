"""Price features of daily bars: returns, risk, averages, range position."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from ..config import PriceFeatureConfig
from ..functions.expressions import EPSILON, guarded, ratio, require_columns
from .panel import LONG_EXTREME, Block, Ewm, FirstKnown, Panel, RunningMax, Step, ema_decay, run_blocks

REQUIRED = ("ticker", "date", "open", "high", "low", "close", "volume")
TRADING_DAYS = 252
# From this length on a mean is taken from running sums.
LONG_WINDOW = 32

TRUE_RANGE = "greatest(high - low, abs(high - {previous}), abs(low - {previous}))"


class Returns(Block):
    """Price change, daily return, and returns over several days."""

    def __init__(self, cfg: PriceFeatureConfig):
        self.cfg = cfg
        self.lookback = max(1, *cfg.return_windows)

    def first(self, panel: Panel) -> dict[str, str]:
        out = {
            "price_change": f"close - {panel.lag('close')}",
            "daily_return": f"{ratio('close', panel.lag('close'))} - 1",
        }
        for n in self.cfg.return_windows:
            change = f"{ratio('close', panel.lag('close', n))} - 1"
            out |= {f"return_{n}d": change, f"momentum_{n}d": change}
        return out

    def columns(self) -> list[str]:
        spans = self.cfg.return_windows
        return ["price_change", "daily_return", *[f"return_{n}d" for n in spans], *[f"momentum_{n}d" for n in spans]]


class Risk(Block):
    """Volatility, mean return and annualised Sharpe ratio of ``daily_return``."""

    def __init__(self, cfg: PriceFeatureConfig):
        self.windows = cfg.volatility_windows
        self.lookback = max(n + 1 for n in self.windows)

    def second(self, panel: Panel) -> dict[str, str]:
        out = {}
        for n in self.windows:
            out[f"return_volatility_{n}d"] = panel.rolling("stddev_samp", "daily_return", n)
            out[f"mean_daily_return_{n}d"] = panel.mean("daily_return", n)
        return out

    def rows(self) -> list[dict[str, str]]:
        return [
            {
                f"sharpe_ratio_{n}d": f"CASE WHEN return_volatility_{n}d > {EPSILON!r}D THEN "
                f"mean_daily_return_{n}d / return_volatility_{n}d * {math.sqrt(TRADING_DAYS)!r}D END"
                for n in self.windows
            }
        ]

    def columns(self) -> list[str]:
        stems = ("return_volatility", "mean_daily_return", "sharpe_ratio")
        return [f"{stem}_{n}d" for stem in stems for n in self.windows]


class Drawdown(Block):
    """Worst drawdown in the window.

    The product of (1 + return) telescopes to close / first close, so the growth
    factor needs no product aggregate. It starts at the first known close; the
    peak starts at the close after that, where the first return is known.
    """

    def __init__(self, cfg: PriceFeatureConfig):
        self.windows = cfg.volatility_windows
        self.lookback = max(self.windows)

    def first(self, panel: Panel) -> dict[str, str]:
        # A slice after the first one follows rows of the key, so only the first can hold the first close.
        earlier = f"count(close) OVER ({panel.window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 0"
        return {"_later_close": f"CASE WHEN {panel.later_slice} OR {earlier} THEN close END"}

    def scans(self, panel: Panel) -> list[Step]:
        return [
            RunningMax("_peak_close", "_later_close"),
            FirstKnown("_base_close", "close"),
        ]

    def second(self, panel: Panel) -> dict[str, str]:
        growth, peak = ratio("close", "_base_close"), ratio("_peak_close", "_base_close")
        fall = f"({growth} - {peak}) / {guarded(peak)}"
        out = {}
        for n in self.windows:
            if n < LONG_EXTREME:
                out[f"max_drawdown_{n}d"] = f"min({fall}) OVER ({panel.frame(n)})"
            else:
                out |= panel.extreme_parts(f"_fall_{n}", f"-({fall})", n)
        return out

    def third(self, panel: Panel) -> dict[str, str]:
        return {f"max_drawdown_{n}d": f"-({panel.long_extreme(f'_fall_{n}', n)})" for n in self.windows if n >= LONG_EXTREME}

    def columns(self) -> list[str]:
        return [f"max_drawdown_{n}d" for n in self.windows]


class SimpleAverages(Block):
    """Moving averages of the close and the distance to them."""

    def __init__(self, windows: tuple[int, ...]):
        self.windows = windows
        self.lookback = max(self.windows)

    def first(self, panel: Panel) -> dict[str, str]:
        return {
            f"sma_{n}": panel.mean("close", n) if n < LONG_WINDOW else panel.long_mean(n) for n in self.windows
        }

    def rows(self) -> list[dict[str, str]]:
        return [{f"close_vs_sma{n}": f"(close - sma_{n}) / {guarded(f'sma_{n}')}" for n in self.windows}]

    def columns(self) -> list[str]:
        return [name for n in self.windows for name in (f"sma_{n}", f"close_vs_sma{n}")]


class ExponentialAverages(Block):
    """Exponential averages that start at the first known close, and the distance to them.

    A missing close leaves the average as it is; older values then weigh less at the next known one.
    """

    def __init__(self, windows: tuple[int, ...]):
        self.windows = windows
        self.decays = tuple(ema_decay(n) for n in windows)

    def scans(self, panel: Panel) -> list[Step]:
        return [Ewm(f"ema_{n}", n, "close", "known_close") for n in self.windows]

    def rows(self) -> list[dict[str, str]]:
        return [{f"close_vs_ema{n}": f"(close - ema_{n}) / {guarded(f'ema_{n}')}" for n in self.windows}]

    def columns(self) -> list[str]:
        return [name for n in self.windows for name in (f"ema_{n}", f"close_vs_ema{n}")]


class RangePosition(Block):
    """Place of the close between the lowest low and the highest high."""

    def __init__(self, windows: tuple[int, ...]):
        self.windows = windows
        self.lookback = max(windows)

    def first(self, panel: Panel) -> dict[str, str]:
        out = {}
        for n in self.windows:
            if n < LONG_EXTREME:
                out |= {f"_low_{n}": panel.rolling("min", "low", n), f"_high_{n}": panel.rolling("max", "high", n)}
            else:
                out |= panel.extreme_parts(f"_fallen_{n}", "-low", n) | panel.extreme_parts(f"_risen_{n}", "high", n)
        return out

    def second(self, panel: Panel) -> dict[str, str]:
        out = {}
        for n in self.windows:
            if n >= LONG_EXTREME:
                out[f"_low_{n}"] = panel.full(n, f"-({panel.long_extreme(f'_fallen_{n}', n)})", "low")
                out[f"_high_{n}"] = panel.full(n, panel.long_extreme(f"_risen_{n}", n), "high")
        return out

    def rows(self) -> list[dict[str, str]]:
        return [
            {
                f"price_vs_{n}d_range": f"(close - _low_{n}) / {guarded(f'_high_{n} - _low_{n}')}"
                for n in self.windows
            }
        ]

    def columns(self) -> list[str]:
        return [f"price_vs_{n}d_range" for n in self.windows]


class TrueRange(Block):
    """True range, its average, and its share of the close."""

    def __init__(self, window: int):
        self.window = window
        self.lookback = window + 1

    def first(self, panel: Panel) -> dict[str, str]:
        return {"true_range": TRUE_RANGE.format(previous=panel.lag("close"))}

    def second(self, panel: Panel) -> dict[str, str]:
        return {f"avg_true_range_{self.window}": panel.mean("true_range", self.window)}

    def rows(self) -> list[dict[str, str]]:
        return [{"tr_percent": f"true_range / {guarded('close')}"}]

    def columns(self) -> list[str]:
        return ["true_range", f"avg_true_range_{self.window}", "tr_percent"]


def price_blocks(cfg: PriceFeatureConfig) -> tuple[Block, ...]:
    return (
        Returns(cfg),
        Risk(cfg),
        Drawdown(cfg),
        SimpleAverages(cfg.sma_windows),
        ExponentialAverages(cfg.ema_windows),
        RangePosition(cfg.price_position_windows),
        TrueRange(cfg.true_range_window),
    )


def price_features(df: DataFrame, config: PriceFeatureConfig | None = None) -> DataFrame:
    """All price columns for a table of daily bars."""
    cfg = config or PriceFeatureConfig()
    require_columns(df, REQUIRED, "price_features")
    done = run_blocks(df, *price_blocks(cfg))
    return done if cfg.keep_na else done.dropna(subset=["close"])
