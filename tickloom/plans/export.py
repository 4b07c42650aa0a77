"""Export of feature tables."""

from __future__ import annotations

from datetime import date, datetime

from ..sources.sinks import ROWS_PER_FILE, write_clustered
from ..sources.tables import MarketTables, Tickers, load_news
from .daily import prepare_daily_features
from .intraday import prepare_intraday_features

_KINDS = ("daily", "intraday", "news")
_ORDER = {"daily": ("ticker", "date"), "intraday": ("ticker", "timestamp"), "news": ("ticker", "published_at")}


def default_name(data_type: str, ticker: str | None, at: datetime) -> str:
    return f"{data_type}_features_{ticker or 'all'}_{at:%Y%m%d_%H%M%S}.parquet"


def export_features_to_parquet(
    tables: MarketTables,
    data_type: str,
    output_path: str,
    ticker: Tickers = None,
    *,
    as_of: date | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    **options,
) -> str:
    """Write the daily or intraday feature table or the raw news; return the path.

    Files hold ranges of ticker and time, so a reader of one ticker skips the others. An empty result is written too,
    with its schema. ``options`` go to the plan;
    :func:`default_name` names a file by its content.
    """
    if data_type not in _KINDS:
        raise ValueError(f"data_type must be 'daily', 'intraday' or 'news', got {data_type!r}")
    if data_type == "daily":
        frame = prepare_daily_features(tables, ticker, **options).features
    elif data_type == "intraday":
        frame = prepare_intraday_features(tables, ticker, as_of=as_of, **options).features
    else:
        frame = load_news(tables.news, ticker)
    write_clustered(frame, output_path, _ORDER[data_type], rows_per_file)
    return output_path
