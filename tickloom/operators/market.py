"""Returns of a ticker against its market index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import divide, ratio, require_columns
from .panel import Block, Panel, run_blocks

BETA_WINDOW = 20
MARKET_COLUMNS = ("market_close", "market_return", "stock_vs_market_return", "relative_return")


def index_returns(index_bars: DataFrame, key: tuple[str, ...] = ()) -> DataFrame:
    """``market_close`` and ``market_return`` per date, and per index when the
    table holds several (``key``).

    An index has one row per day, a few thousand rows in all, which bounds the
    single window group.
    """
    require_columns(index_bars, ("date", "close", *key), "index_returns")
    in_order = Window.partitionBy(*(key or [F.lit(0)])).orderBy("date")
    return index_bars.select(
        *key,
        "date",
        F.col("close").alias("market_close"),
        (divide(F.col("close"), F.lag("close").over(in_order)) - 1).alias("market_return"),
    )


def attach_index(bars: DataFrame, index: DataFrame, key: tuple[str, ...] = ()) -> DataFrame:
    """Left join of the index columns by date. Spark broadcasts the index when its
    size is under the broadcast threshold and sorts and merges otherwise."""
    return bars.join(index, [*key, "date"], "left")


def relative_columns() -> dict:
    own, market = F.col("daily_return"), F.col("market_return")
    return {"stock_vs_market_return": own - market, "relative_return": divide(own, market)}


class Beta(Block):
    """Slope of the ticker's return on the market's over rows with both known."""

    def __init__(self, window: int = BETA_WINDOW):
        self.window = window
        self.lookback = window + 1

    def first(self, panel: Panel) -> dict[str, str]:
        return {"daily_return": f"{ratio('close', panel.lag('close'))} - 1"}

    def second(self, panel: Panel) -> dict[str, str]:
        both = "daily_return + market_return"
        fit = f"regr_slope(daily_return, market_return) OVER ({panel.frame(self.window)})"
        return {f"beta_{self.window}d": panel.full(self.window, fit, both)}

    def columns(self) -> list[str]:
        return ["daily_return", f"beta_{self.window}d"]


class DailyReturn(Block):
    def first(self, panel: Panel) -> dict[str, str]:
        return {"daily_return": f"{ratio('close', panel.lag('close'))} - 1"}

    def columns(self) -> list[str]:
        return ["daily_return"]


def market_features(bars: DataFrame, index_bars: DataFrame, beta: bool = False) -> DataFrame:
    """Add the market columns; ``daily_return`` is computed when it is absent.
    ``beta`` adds the rolling beta, which needs the rows in order."""
    require_columns(bars, ("ticker", "date", "close"), "market_features")
    joined = attach_index(bars, index_returns(index_bars))
    if beta:
        joined = run_blocks(joined, Beta())
    elif "daily_return" not in bars.columns:
        joined = run_blocks(joined, DailyReturn())
    return joined.withColumns(relative_columns())
