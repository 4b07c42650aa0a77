"""Symbol dimension: tickers followed by default and their market index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_INDEX = "SPY"

# Default universe.
SYMBOLS = (
    "AAPL", "MSFT", "GOOGL", "AMZN", "META", "NVDA", "INTC", "CSCO", "ORCL", "IBM", "JPM", "BAC", "WFC", "GS",
    "MS", "V", "MA", "AXP", "JNJ", "PFE", "MRK", "ABBV", "LLY", "XOM", "CVX", "COP", "NEE", "WMT", "COST",
    "TGT", "HD", "PG", "KO", "PEP", "TSLA", "F", "GM", "CAT", "BA", "CMCSA", "DIS", "NFLX", "T", "BABA", "TM",
    "TSM", "HSBC",
)


def get_market_index(ticker: str | None) -> str:
    """Index a ticker is compared with; every ticker uses the default one."""
    return DEFAULT_INDEX


def symbol_dimension(spark: SparkSession) -> DataFrame:
    """``ticker, market_index`` of the default universe."""
    rows = [(ticker, get_market_index(ticker)) for ticker in SYMBOLS]
    return spark.createDataFrame(rows, "ticker string, market_index string")


def backfill_tickers(symbols: DataFrame) -> DataFrame:
    """Tickers of the dimension together with the indices they refer to."""
    return (
        symbols.select("ticker")
        .unionByName(symbols.select(F.col("market_index").alias("ticker")))
        .distinct()
    )


def with_market_index(df: DataFrame, symbols: DataFrame | None) -> DataFrame:
    """Add ``market_index``; tickers outside the dimension use the default."""
    if symbols is None:
        return df.withColumn("market_index", F.lit(DEFAULT_INDEX))
    # One index per ticker, so that a repeated dimension row repeats no bar.
    one = symbols.groupBy("ticker").agg(F.min("market_index").alias("market_index"))
    return df.join(one, "ticker", "left").withColumn(
        "market_index", F.coalesce("market_index", F.lit(DEFAULT_INDEX))
    )
