"""Intraday feature table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TimeFeatureConfig, VolumeFeatureConfig
from ..functions.expressions import complete_rows, q
from ..functions.session_clock import clock_columns, in_market_hours, local_time
from ..operators import candles, volume
from ..operators.panel import DEFAULT_SLICE_ROWS, run_blocks
from ..operators.quality import (
    Boundary,
    SecondDistance,
    calendar_columns,
    fill_gaps,
    history_cutoff,
    intraday_gaps,
    neighbor_table,
)
from ..operators.upsert import INTRADAY_POLICY, merge_batch
from ..sources.sinks import persist_counted
from ..sources.tables import MarketTables, Tickers, scan_intraday_bars

LOADED = (
    "ticker",
    "timestamp",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "transactions",
    "volume_weighted_avg_price",
    "date",
    "is_monday",
    "is_friday",
    "seconds_since_prev_bar",
)


@dataclass(frozen=True)
class IntradayFeatures:
    """``rows`` is the number of saved rows, None where nothing was saved."""

    features: DataFrame
    gaps: DataFrame
    neighbors: DataFrame
    rows: int | None = None


def recent_bars(bars: DataFrame, as_of: date | Column | None, max_years_back: int | None) -> DataFrame:
    """All bars, or those of the last years; a plain comparison of the stored
    timestamp, so it reaches the scan."""
    if max_years_back is None:
        return bars
    return bars.filter(F.col("timestamp") >= history_cutoff(as_of, max_years_back).cast("timestamp"))


def intraday_table(
    bars: DataFrame,
    volume_config: VolumeFeatureConfig | None = None,
    time_config: TimeFeatureConfig | None = None,
    slice_rows: int = DEFAULT_SLICE_ROWS,
) -> DataFrame:
    """Candle, clock, volume and boundary columns of the bars in market hours.

    Candle lags see all bars, volume windows only those in market hours, so the
    rows are put in order twice. Only the lagged values travel between the two;
    everything that needs one row alone is added at the end.
    """
    v_cfg, t_cfg = volume_config or VolumeFeatureConfig(), time_config or TimeFeatureConfig()
    seen = run_blocks(
        bars, candles.EarlierBars(), SecondDistance(), order="timestamp", slice_rows=slice_rows
    )
    session = seen.filter(in_market_hours(local_time(F.col("timestamp"), t_cfg), t_cfg))
    blocks = volume.volume_blocks(v_cfg, liquidity=False)
    wide = run_blocks(session, *blocks, Boundary(), order="timestamp", slice_rows=slice_rows)
    at = F.col("timestamp")
    wide = wide.withColumns({"date": F.to_date(at)} | calendar_columns(at))
    added = candles.candle_columns() | clock_columns(local_time(at, t_cfg), t_cfg)
    names = [*LOADED, *added, *[c for b in blocks for c in b.columns()], *Boundary().columns()]
    return wide.withColumns(added).select(*[q(c) for c in names])


def prepare_intraday_features(
    tables: MarketTables,
    ticker: Tickers = None,
    save_path: str | None = None,
    *,
    as_of: date | None = None,
    volume_config: VolumeFeatureConfig | None = None,
    time_config: TimeFeatureConfig | None = None,
    landed: DataFrame | None = None,
    max_years_back: int | None = None,
    expected_interval_minutes: int = 5,
) -> IntradayFeatures:
    """Complete rows of the intraday feature table, the gaps, and the boundary rows.

    ``landed`` holds bars fetched for the gaps; when given, those at missing
    timestamps are merged in before anything else is computed. ``max_years_back``
    (counted from ``as_of``) leaves older bars out on request.
    """
    bars = recent_bars(scan_intraday_bars(tables.intraday, ticker), as_of, max_years_back)
    if landed is not None:
        gaps = intraday_gaps(bars, expected_interval_minutes)
        found = fill_gaps(gaps, scan_intraday_bars(landed, ticker), as_of, max_years_back).bars
        bars = merge_batch(bars, found.select(*bars.columns), INTRADAY_POLICY)
    table = intraday_table(bars, volume_config, time_config)
    features, rows = persist_counted(complete_rows(table), save_path)
    return IntradayFeatures(features, intraday_gaps(bars, expected_interval_minutes), neighbor_table(table), rows)
