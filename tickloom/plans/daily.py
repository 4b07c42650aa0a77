"""Daily feature table: one pass over the ordered bars of every ticker."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (
    ConfluenceConfig,
    NewsFeatureConfig,
    PriceFeatureConfig,
    TechnicalIndicatorConfig,
    TimeFeatureConfig,
    VolumeFeatureConfig,
)
from ..functions.expressions import complete_rows, q
from ..functions.session_clock import local_time
from ..operators import candles, confluence, market, news, price, technical, volume
from ..operators.clock import time_features
from ..operators.panel import DEFAULT_SLICE_ROWS, Block, run_blocks
from ..operators.quality import DayDistance, calendar_columns, daily_gaps
from ..sources.sinks import persist_counted
from ..sources.symbols import DEFAULT_INDEX, with_market_index
from ..sources.tables import MarketTables, Tickers, filter_tickers, load_index, scan_daily_bars

CARRIED = ("transactions", "volume_weighted_avg_price", "is_monday", "is_friday", "days_since_prev_close")
BASE = ("ticker", "date", "open", "high", "low", "close", "volume")
# Names of the intraday columns in the output.
INTRADAY_COLUMNS = (
    "hammer_count",
    "bullish_engulf_count",
    "bearish_engulf_count",
    "opening_activity",
    "closing_activity",
    "avg_body_size",
    "max_range_pct",
)


@dataclass(frozen=True)
class DailyFeatures:
    """``rows`` is the number of saved rows, None where nothing was saved."""

    features: DataFrame
    gaps: DataFrame
    rows: int | None = None


def confluence_table(
    bars: DataFrame,
    intraday: DataFrame | None = None,
    news_articles: DataFrame | None = None,
    *,
    index: DataFrame | None = None,
    index_key: tuple[str, ...] = (),
    with_news: bool | None = None,
    price_config: PriceFeatureConfig | None = None,
    volume_config: VolumeFeatureConfig | None = None,
    technical_config: TechnicalIndicatorConfig | None = None,
    time_config: TimeFeatureConfig | None = None,
    news_config: NewsFeatureConfig | None = None,
    confluence_config: ConfluenceConfig | None = None,
    extra_blocks: Sequence[Block] = (),
    slice_rows: int = DEFAULT_SLICE_ROWS,
) -> DataFrame:
    """All daily blocks with the confirmation flags and scores.

    Index, news and intraday columns are joined while the rows are narrow. The
    price, technical and volume blocks then share one panel, and the rest is
    row-wise, so no join or shuffle ever carries the wide rows. ``extra_blocks``
    run in the same panel and add their columns.
    """
    p_cfg = price_config or PriceFeatureConfig()
    v_cfg = volume_config or VolumeFeatureConfig()
    t_cfg = technical_config or TechnicalIndicatorConfig()
    n_cfg = news_config or NewsFeatureConfig()
    with_news = news_articles is not None if with_news is None else with_news

    rows = bars
    if index is not None:
        rows = market.attach_index(rows, index, index_key)
    if with_news:
        rows = news.attach_news(rows, news_articles, n_cfg)
    if intraday is not None:
        rows = rows.join(daily_from_intraday(intraday, time_config), ["ticker", "date"], "left")

    blocks = [
        *price.price_blocks(p_cfg),
        *technical.technical_blocks(t_cfg),
        *volume.volume_blocks(v_cfg),
        *extra_blocks,
    ]
    wide = run_blocks(rows, DayDistance(), *blocks, slice_rows=slice_rows)
    wide = wide.withColumns(calendar_columns(F.col("date")))
    if not p_cfg.keep_na:
        wide = wide.dropna(subset=["close"])
    wide = confluence.confluence_features(wide, confluence_config, p_cfg, t_cfg)
    if index is not None:
        wide = wide.withColumns(market.relative_columns())
    order = [*BASE, *CARRIED, *[c for b in blocks for c in b.columns()]]
    order += news.NEWS_COLUMNS if with_news else ()
    order += INTRADAY_COLUMNS if intraday is not None else ()
    order += confluence.CONFLUENCE_COLUMNS
    order += market.MARKET_COLUMNS if index is not None else ()
    return wide.select(*[q(c) for c in dict.fromkeys(order) if c in wide.columns])


def daily_from_intraday(intraday: DataFrame, time_config: TimeFeatureConfig | None = None) -> DataFrame:
    """Candle and session counts per ticker and local day."""
    cfg = time_config or TimeFeatureConfig()
    bars = time_features(candles.candle_features(intraday), cfg)
    return candles.intraday_rollup(
        bars.withColumn("local_date", F.to_date(local_time(F.col("timestamp"), cfg)))
    )


def row_counts(features: DataFrame) -> DataFrame:
    """Rows per ticker of a feature table."""
    return features.groupBy("ticker").agg(F.count(F.lit(1)).alias("rows"))


def index_bars(tables: MarketTables) -> DataFrame:
    """Bars of the indices that the symbols refer to, and of the default one."""
    if tables.symbols is None:
        bars = load_index(tables.daily, DEFAULT_INDEX)
        return bars.withColumn("market_index", F.lit(DEFAULT_INDEX))
    names = tables.symbols.select(F.col("market_index").alias("ticker"))
    names = names.unionByName(names.sparkSession.range(1).select(F.lit(DEFAULT_INDEX).alias("ticker"))).distinct()
    return tables.daily.join(names, "ticker", "left_semi").select(
        F.col("ticker").alias("market_index"), "date", F.col("close").cast("double").alias("close")
    )


def prepare_daily_features(
    tables: MarketTables,
    ticker: Tickers = None,
    save_path: str | None = None,
    *,
    price_config: PriceFeatureConfig | None = None,
    volume_config: VolumeFeatureConfig | None = None,
    technical_config: TechnicalIndicatorConfig | None = None,
    news_config: NewsFeatureConfig | None = None,
    confluence_config: ConfluenceConfig | None = None,
    include_news_features: bool = False,
) -> DailyFeatures:
    """Complete rows of the daily feature table, and the gaps of the bars.

    Every ticker is compared with its own index, whose bars are in the same table;
    the market columns are null where those bars are missing.
    """
    bars = with_market_index(scan_daily_bars(tables.daily, ticker), tables.symbols)
    indices = index_bars(tables)
    table = confluence_table(
        bars,
        None,
        filter_tickers(tables.news, ticker) if include_news_features and tables.news is not None else None,
        index=market.index_returns(indices, ("market_index",)),
        index_key=("market_index",),
        with_news=include_news_features,
        price_config=price_config,
        volume_config=volume_config,
        technical_config=technical_config,
        news_config=news_config,
        confluence_config=confluence_config,
    )
    # Days on which the index is unknown are complete without its columns.
    own = [c for c in table.columns if c not in market.MARKET_COLUMNS]
    features, rows = persist_counted(complete_rows(table, own), save_path)
    return DailyFeatures(features, daily_gaps(bars), rows)
