"""Time-of-day features of intraday bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TimeFeatureConfig
from ..functions.expressions import require_columns
from ..functions.session_clock import clock_columns, in_market_hours, local_time


def time_features(
    df: DataFrame, config: TimeFeatureConfig | None = None, timestamp_col: str = "timestamp"
) -> DataFrame:
    """Add the clock columns. The timestamp itself stays in UTC."""
    cfg = config or TimeFeatureConfig()
    require_columns(df, (timestamp_col,), "time_features")
    return df.withColumns(clock_columns(local_time(F.col(timestamp_col), cfg), cfg))


def market_hours_only(
    df: DataFrame, config: TimeFeatureConfig | None = None, timestamp_col: str = "timestamp"
) -> DataFrame:
    """Bars that start within the session."""
    cfg = config or TimeFeatureConfig()
    return df.filter(in_market_hours(local_time(F.col(timestamp_col), cfg), cfg))
