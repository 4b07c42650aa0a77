"""Technical indicators in their published definitions, per ticker.

Seeds and smoothing (the values converge whatever the seed; these are the rules
used here):

* EMA of length n: null for the first n-1 rows, the mean of the first n values
  at row n, then ``y += (x - y) * 2 / (n + 1)``.
  A missing value adds nothing: the average carries on, and older values weigh
  less at the next known one. The seed is the mean of what is known of the first n rows.
* Wilder's average of length n: weights ``(1 - 1/n)**age`` normalised over the
  known values, null before n of them are known.
* True range inside ATR starts at the second row, where the previous close exists.
* MACD signal: EMA over the MACD line, counted from its first value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import TechnicalIndicatorConfig
from ..functions.expressions import guarded, ratio, require_columns
from .panel import INDEX, MEAN_SO_FAR, Affine, Block, Ewm, Panel, RunningCount, Step, ema_decay, run_blocks, wilder_decay
from .price import TRUE_RANGE

REQUIRED = ("open", "high", "low", "close", "volume")


def _from(position: int, value: str) -> str:
    return f"CASE WHEN {INDEX} >= {position} THEN {value} END"


def _seeded(name: str, value: str, mean: str, n: int, first: int = 0) -> Ewm:
    """EMA whose input starts at position ``first``: its first value is ``mean``, the mean of
    the values so far, once n rows are seen."""
    seed_at = first + n - 1
    return Ewm(name, n, f"CASE WHEN {INDEX} = {seed_at} THEN {mean} WHEN {INDEX} > {seed_at} THEN {value} END", name)


def _average(name: str) -> str:
    return ratio(name, f"{name}_weight")


def _wilder(name: str, value: str, n: int) -> list[Step]:
    """Decayed sum of the known values, of their weights, and their count."""
    decay = wilder_decay(n)
    known = f"CASE WHEN {value} IS NOT NULL THEN 1D END"
    return [Affine(name, decay, value), Affine(f"{name}_weight", decay, known), RunningCount(f"{name}_count", value)]


def _wilder_mean(name: str, n: int) -> str:
    return f"CASE WHEN {name}_count >= {n} THEN {_average(name)} END"


class Rsi(Block):
    """Share of the averaged gains in all averaged moves, in percent."""

    def __init__(self, length: int):
        self.length = length
        self.decays = (wilder_decay(length),)

    def first(self, panel: Panel) -> dict[str, str]:
        return {"_change": f"close - {panel.lag('close')}"}

    def scans(self, panel: Panel) -> list[Step]:
        decay = self.decays[0]
        return [
            Affine("_gain", decay, f"CASE WHEN {INDEX} >= 1 THEN greatest(_change, 0D) END"),
            Affine("_loss", decay, f"CASE WHEN {INDEX} >= 1 THEN greatest(-_change, 0D) END"),
        ]

    def rows(self) -> list[dict[str, str]]:
        value = f"{ratio('_gain', '_gain + _loss')} * 100"
        return [{f"rsi_{self.length}": _from(self.length, value)}]

    def columns(self) -> list[str]:
        return [f"rsi_{self.length}"]


class Macd(Block):
    """Difference of two EMAs, its own EMA, and the difference of those."""

    def __init__(self, fast: int, slow: int, signal: int):
        self.fast, self.slow, self.signal = fast, slow, signal
        self.base = f"{fast}_{slow}_{signal}"
        self.start = max(fast, slow) - 1
        self.seed_rows = self.start + signal
        self.decays = tuple(ema_decay(n) for n in (fast, slow, signal))

    def scans(self, panel: Panel) -> list[Step]:
        return [
            _seeded("_ema_fast", "close", MEAN_SO_FAR, self.fast),
            _seeded("_ema_slow", "close", MEAN_SO_FAR, self.slow),
        ]

    def second(self, panel: Panel) -> dict[str, str]:
        line = _from(self.start, "_ema_fast - _ema_slow")
        return {f"macd_{self.base}": line, "_mean_line": f"avg({line}) OVER ({panel.so_far})"}

    def late_scans(self, panel: Panel) -> list[Step]:
        return [_seeded("_ema_line", f"macd_{self.base}", "_mean_line", self.signal, self.start)]

    def rows(self) -> list[dict[str, str]]:
        signal = _from(self.start + self.signal - 1, "_ema_line")
        return [
            {
                f"macd_signal_{self.base}": signal,
                f"macd_hist_{self.base}": f"macd_{self.base} - {signal}",
            }
        ]

    def columns(self) -> list[str]:
        return [f"macd_{self.base}", f"macd_signal_{self.base}", f"macd_hist_{self.base}"]


class Stochastic(Block):
    """Place of the close in the recent range, smoothed once (%K) and twice (%D)."""

    def __init__(self, k: int, d: int, smooth: int):
        self.k, self.d, self.smooth = k, d, smooth
        self.base = f"{k}_{d}_{smooth}"
        self.lookback = k + d + smooth

    def first(self, panel: Panel) -> dict[str, str]:
        low, high = panel.rolling("min", "low", self.k), panel.rolling("max", "high", self.k)
        return {f"_floor_{self.k}": low, f"_ceiling_{self.k}": high}

    def second(self, panel: Panel) -> dict[str, str]:
        low, high = f"_floor_{self.k}", f"_ceiling_{self.k}"
        raw = f"({ratio(f'close - {low}', f'{high} - {low}')} * 100)"
        return {f"stoch_k_{self.base}": panel.mean(raw, self.smooth)}

    def third(self, panel: Panel) -> dict[str, str]:
        return {f"stoch_d_{self.base}": panel.mean(f"stoch_k_{self.base}", self.d)}

    def columns(self) -> list[str]:
        return [f"stoch_k_{self.base}", f"stoch_d_{self.base}"]


class Bollinger(Block):
    """Mean plus and minus a multiple of the standard deviation (divisor n - ddof)."""

    def __init__(self, length: int, width: float, ddof: int = 1):
        self.length, self.width, self.ddof = length, width, ddof
        self.base = f"{length}_{width}"
        self.lookback = length

    def first(self, panel: Panel) -> dict[str, str]:
        function = "stddev_samp" if self.ddof == 1 else "stddev_pop"
        return {
            f"bb_middle_{self.base}": panel.mean("close", self.length),
            "_band": f"{panel.rolling(function, 'close', self.length)} * {self.width!r}D",
        }

    def rows(self) -> list[dict[str, str]]:
        middle, lower, upper = (f"`bb_{side}_{self.base}`" for side in ("middle", "lower", "upper"))
        return [
            {f"bb_lower_{self.base}": f"{middle} - _band", f"bb_upper_{self.base}": f"{middle} + _band"},
            {
                f"bb_bandwidth_{self.base}": f"({upper} - {lower}) / {guarded(middle)}",
                f"bb_pct_{self.base}": ratio(f"close - {lower}", f"{upper} - {lower}"),
            },
        ]

    def columns(self) -> list[str]:
        return [f"bb_{side}_{self.base}" for side in ("lower", "middle", "upper", "bandwidth", "pct")]


class AverageTrueRange(Block):
    """Average true range and its share of the close."""

    def __init__(self, length: int, smoothing: str = "wilder"):
        if smoothing not in ("wilder", "sma"):
            raise ValueError("smoothing must be 'wilder' or 'sma'")
        self.length, self.smoothing = length, smoothing
        self.lookback = length + 1
        self.decays = (wilder_decay(length),)

    def first(self, panel: Panel) -> dict[str, str]:
        return {"_bar_range": _from(1, TRUE_RANGE.format(previous=panel.lag("close")))}

    def scans(self, panel: Panel) -> list[Step]:
        return _wilder("_range_sum", "_bar_range", self.length) if self.smoothing == "wilder" else []

    def second(self, panel: Panel) -> dict[str, str]:
        if self.smoothing == "sma":
            return {f"atr_{self.length}": panel.mean("_bar_range", self.length)}
        return {f"atr_{self.length}": _wilder_mean("_range_sum", self.length)}

    def rows(self) -> list[dict[str, str]]:
        share = ratio(f"atr_{self.length}", "close")
        return [{f"atr_pct_{self.length}": share, "atr": f"atr_{self.length}", "atr_pct": share}]

    def columns(self) -> list[str]:
        return [f"atr_{self.length}", f"atr_pct_{self.length}", "atr", "atr_pct"]


class Adx(Block):
    """Average of the relative difference of upward and downward moves, in percent."""

    def __init__(self, length: int):
        self.length = length
        self.decays = (wilder_decay(length),)

    def first(self, panel: Panel) -> dict[str, str]:
        return {"_up": f"high - {panel.lag('high')}", "_down": f"{panel.lag('low')} - low"}

    def scans(self, panel: Panel) -> list[Step]:
        decay = self.decays[0]
        return [
            Affine("_rise", decay, "CASE WHEN _up > _down AND _up > 0 THEN _up WHEN _up + _down IS NOT NULL THEN 0D END"),
            Affine("_fall", decay, "CASE WHEN _down > _up AND _down > 0 THEN _down WHEN _up + _down IS NOT NULL THEN 0D END"),
        ]

    def second(self, panel: Panel) -> dict[str, str]:
        # The common divisor (average true range and weights) cancels in the ratio.
        # A bar with unknown moves has no index of its own.
        index = f"{ratio('abs(_rise - _fall)', '_rise + _fall')} * 100"
        return {"_dx": _from(self.length, f"CASE WHEN _up + _down IS NOT NULL THEN {index} END")}

    def late_scans(self, panel: Panel) -> list[Step]:
        return _wilder("_dx_sum", "_dx", self.length)

    def rows(self) -> list[dict[str, str]]:
        value = _wilder_mean("_dx_sum", self.length)
        return [{f"adx_{self.length}": value, "adx": value}]

    def columns(self) -> list[str]:
        return [f"adx_{self.length}", "adx"]


class SeededEma(Block):
    """EMA seeded with the mean of its first values."""

    def __init__(self, length: int):
        self.length = self.seed_rows = length
        self.decays = (ema_decay(length),)

    def scans(self, panel: Panel) -> list[Step]:
        return [_seeded("_ema_tail", "close", MEAN_SO_FAR, self.length)]

    def rows(self) -> list[dict[str, str]]:
        return [{f"ema_{self.length}": _from(self.length - 1, "_ema_tail")}]

    def columns(self) -> list[str]:
        return [f"ema_{self.length}"]


class LinearAverages(Block):
    """Plain mean, and the mean with linear weights, the newest value weighing n."""

    def __init__(self, sma_length: int, wma_length: int):
        self.sma, self.wma = sma_length, wma_length
        self.lookback = max(sma_length, wma_length)

    def first(self, panel: Panel) -> dict[str, str]:
        n = self.wma
        parts = [f"close * {n}", *[f"{panel.lag('close', k)} * {n - k}" for k in range(1, n)]]
        value = panel.full(n, f"({' + '.join(parts)}) / {n * (n + 1) / 2!r}D", "close")
        return {f"sma_{self.sma}": panel.mean("close", self.sma), f"wma_{n}": value}

    def columns(self) -> list[str]:
        return [f"sma_{self.sma}", f"wma_{self.wma}"]


def technical_blocks(cfg: TechnicalIndicatorConfig) -> tuple[Block, ...]:
    return (
        Rsi(cfg.rsi_length),
        Macd(cfg.macd_fast, cfg.macd_slow, cfg.macd_signal),
        Stochastic(cfg.stochastic_k, cfg.stochastic_d, cfg.stochastic_smooth),
        Bollinger(cfg.bollinger_length, cfg.bollinger_std, cfg.bollinger_ddof),
        AverageTrueRange(cfg.atr_length, cfg.atr_smoothing),
        Adx(cfg.adx_length),
        SeededEma(cfg.ema_length),
        LinearAverages(cfg.sma_length, cfg.wma_length),
    )


def technical_features(
    df: DataFrame, config: TechnicalIndicatorConfig | None = None, order: str = "date"
) -> DataFrame:
    """All indicator columns for a table of bars."""
    require_columns(df, ("ticker", order, *REQUIRED), "technical_features")
    return run_blocks(df, *technical_blocks(config or TechnicalIndicatorConfig()), order=order)
