"""Ingest ledger: what was fetched, and what to fetch next."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DATA_TYPES, STATUSES

MODES = ("resume", "full")
# Chunk length per request when resuming and in a full run; None is one chunk.
RESUME_CHUNK_DAYS = {"daily": 30, "intraday": 30, "news": 7}
REQUEST_CHUNK_DAYS = {"daily": None, "intraday": None, "news": 7}
DEFAULT_LOOKBACK_DAYS = 730


def _check_type(data_type: str) -> None:
    if data_type not in DATA_TYPES:
        raise ValueError(f"data_type must be one of {DATA_TYPES}, got {data_type!r}")


def _as_date(value: str | date | Column | None) -> Column | None:
    if value is None or isinstance(value, Column):
        return value
    return F.lit(value).cast("date")


def last_fetch(ledger: DataFrame) -> DataFrame:
    """Date of the latest completed fetch of every ticker and data type."""
    return (
        ledger.filter(F.col("status") == "completed")
        .groupBy("ticker", "data_type")
        .agg(F.max_by("last_fetch_date", "updated_at").alias("last_fetch_date"))
    )


def get_last_fetch_date(ledger: DataFrame, ticker: str, data_type: str) -> date | None:
    """The same for one ticker, as a value."""
    one = ledger.filter((F.col("ticker") == ticker) & (F.col("data_type") == data_type))
    rows = last_fetch(one).select("last_fetch_date").take(1)
    return rows[0][0] if rows else None


def resolve_date_ranges(
    tickers: DataFrame,
    ledger: DataFrame | None,
    data_type: str,
    mode: str,
    as_of: date,
    start_date: str | date | None = None,
    end_date: str | date | None = None,
    lookback_days: int = DEFAULT_LOOKBACK_DAYS,
) -> DataFrame:
    """``ticker, start_date, end_date`` to fetch.

    The end is the given one but never later than the day before ``as_of``. In
    full mode the start is given; in resume mode it follows the last fetch, or
    lies ``lookback_days`` before the end when there is none.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    _check_type(data_type)
    yesterday = F.date_sub(F.lit(as_of).cast("date"), 1)
    end = F.least(F.coalesce(_as_date(end_date), yesterday), yesterday) if end_date else yesterday
    if mode == "full":
        if start_date is None:
            raise ValueError("a start date is required in full mode")
        return tickers.select("ticker", _as_date(start_date).alias("start_date"), end.alias("end_date"))
    if ledger is None:
        known = tickers.select("ticker").withColumn("last_fetch_date", F.lit(None).cast("date"))
    else:
        fetched = last_fetch(ledger.filter(F.col("data_type") == data_type))
        known = tickers.select("ticker").join(fetched.select("ticker", "last_fetch_date"), "ticker", "left")
    start = F.coalesce(F.date_add("last_fetch_date", 1), F.date_sub(end, lookback_days))
    return known.select("ticker", F.least(start, end).alias("start_date"), end.alias("end_date"))


def backfill_plan(
    tickers: DataFrame,
    ledger: DataFrame | None,
    data_type: str,
    mode: str,
    as_of: date,
    start_date: str | date | None = None,
    end_date: str | date | None = None,
    lookback_days: int = DEFAULT_LOOKBACK_DAYS,
    chunk_days: int | None = None,
) -> DataFrame:
    """Date ranges cut, to their ends, into the chunks to fetch.

    ``chunk_days`` is the length of a chunk; by default it is that of the mode and data type.
    """
    ranges = resolve_date_ranges(
        tickers, ledger, data_type, mode, as_of, start_date, end_date, lookback_days
    )
    days = chunk_days or (RESUME_CHUNK_DAYS if mode == "resume" else REQUEST_CHUNK_DAYS)[data_type]
    if days is None:
        return ranges
    starts = F.sequence("start_date", "end_date", F.expr(f"interval {days} days"))
    return (
        ranges.filter(F.col("start_date") <= F.col("end_date"))
        .withColumn("_start", F.explode(starts))
        .select(
            "ticker",
            F.col("_start").alias("start_date"),
            F.least(F.date_add("_start", days - 1), F.col("end_date")).alias("end_date"),
        )
    )


def ledger_rows(
    chunks: DataFrame, data_type: str, as_of: Column | None = None
) -> DataFrame:
    """Ledger rows for chunks with ``rows_inserted`` and ``error_message``; a
    message marks a failed chunk. Success is dated only when there was one."""
    _check_type(data_type)
    failed = F.col("error_message").isNotNull()
    completed, failure = STATUSES[2], STATUSES[3]
    return chunks.select(
        "ticker",
        F.lit(data_type).alias("data_type"),
        F.col("start_date").alias("date_range_start"),
        F.col("end_date").alias("date_range_end"),
        F.col("end_date").alias("last_fetch_date"),
        F.when(~failed, F.col("end_date")).alias("last_success_date"),
        F.when(failed, F.lit(failure)).otherwise(F.lit(completed)).alias("status"),
        F.col("error_message").alias("error_message"),
        F.col("rows_inserted").cast("int").alias("rows_inserted"),
        (F.current_timestamp() if as_of is None else as_of).alias("updated_at"),
    )


def append_ledger(rows: DataFrame, path: str) -> None:
    """Add the rows in one commit: readers see all of them or none."""
    rows.write.mode("append").parquet(path)


def ledger_has_batch(spark: SparkSession, path: str, batch_id: str) -> bool:
    """Whether a stored ledger has rows of a batch; a ledger that does not exist yet has none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return False
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    return "batch_id" in rows.columns and not rows.where(F.col("batch_id") == batch_id).isEmpty()
