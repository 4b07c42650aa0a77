"""Applying landed batches of a fetch plan to a table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import append_ledger, ledger_has_batch, ledger_rows
from ..operators.upsert import DAILY_POLICY, INTRADAY_POLICY, NEWS_POLICY, KeyIndex, last_per_key, merge_batch, month_of, news_defaults, upsert_table
from ..operators.quality import fetch_ranges, intraday_gaps, missing_bars, remaining_gaps

_POLICIES = {"daily": DAILY_POLICY, "intraday": INTRADAY_POLICY, "news": NEWS_POLICY}
_DAY = {
    "daily": lambda: F.col("date"),
    "intraday": lambda: F.to_date("timestamp"),
    "news": lambda: F.to_date("published_at"),
}


@dataclass(frozen=True)
class BackfillResult:
    table: DataFrame
    ledger: DataFrame


def _placed(landed: DataFrame, plan: DataFrame, data_type: str, failures: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The chunks with the message of their failure, and the landed rows of those that did not fail."""
    chunk = ["ticker", "start_date", "end_date"]
    if failures is None:
        chunks = plan.select(*chunk).withColumn("error_message", F.lit(None).cast("string"))
    else:
        chunks = plan.select(*chunk).join(failures.select(*chunk, "error_message"), chunk, "left")
    # One row per chunk and day turns the range test into an equality.
    days = chunks.filter(F.col("error_message").isNull() & (F.col("start_date") <= F.col("end_date"))).select(
        *chunk, F.explode(F.sequence("start_date", "end_date")).alias("_day")
    )
    return chunks, landed.withColumn("_day", _DAY[data_type]()).join(days, ["ticker", "_day"]).drop("_day")


def _report(chunks: DataFrame, placed: DataFrame, data_type: str, as_of: Column | None) -> DataFrame:
    chunk = ["ticker", "start_date", "end_date"]
    counts = placed.groupBy(*chunk).agg(F.count(F.lit(1)).alias("rows_inserted"))
    return ledger_rows(chunks.join(counts, chunk, "left").fillna(0, subset=["rows_inserted"]), data_type, as_of)


def _batch(placed: DataFrame, data_type: str) -> DataFrame:
    batch = placed.drop("start_date", "end_date")
    return news_defaults(batch) if data_type == "news" else batch


def apply_backfill(
    base: DataFrame,
    landed: DataFrame,
    plan: DataFrame,
    data_type: str,
    failures: DataFrame | None = None,
    as_of: Column | None = None,
    sequence: str | None = None,
) -> BackfillResult:
    """Merge the landed rows of a plan's chunks and report every chunk.

    ``failures`` lists chunks whose fetch failed (``ticker, start_date, end_date,
    error_message``); nothing of them is merged. A chunk without rows counts as
    completed with 0 rows.
    """
    chunks, placed = _placed(landed, plan, data_type, failures)
    merged = merge_batch(base, _batch(placed, data_type), _POLICIES[data_type], as_of, sequence)
    return BackfillResult(merged, _report(chunks, placed, data_type, as_of))


def store_backfill(
    spark: SparkSession,
    table: str,
    ledger: str,
    landed: DataFrame,
    plan: DataFrame,
    data_type: str,
    failures: DataFrame | None = None,
    as_of: Column | None = None,
    sequence: str | None = None,
    batch_id: str | None = None,
    index: KeyIndex | None = None,
) -> bool:
    """The same, into a stored table (partitioned by month) and a stored ledger; false if the batch was stored before.

    The ledger is written last and in one commit, and its rows carry the ``batch_id``. A run that breaks off before leaves a table that
    may hold the batch already, which a repeat merges to the same rows; a repeat of a whole run finds its
    ``batch_id`` and changes nothing. So table and ledger agree after any number of attempts. Without a
    ``batch_id`` every call appends ledger rows. ``index`` spares the search for the partitions of news.
    """
    if batch_id is not None and ledger_has_batch(spark, ledger, batch_id):
        return False
    time = {"daily": "date", "intraday": "timestamp", "news": "published_at"}[data_type]
    chunks, placed = _placed(landed, plan, data_type, failures)
    batch = _batch(placed, data_type).withColumn("month", month_of(time))
    upsert_table(spark, table, batch, _POLICIES[data_type], as_of=as_of, sequence=sequence, key_fixes_partition=data_type != "news", index=index)
    report = _report(chunks, placed, data_type, as_of)
    append_ledger(report if batch_id is None else report.withColumn("batch_id", F.lit(batch_id)), ledger)
    return True


@dataclass(frozen=True)
class StoredFill:
    """Result of filling a stored table: the gaps that stay, the rounds that brought bars, and how many."""

    gaps: DataFrame
    rounds: int
    bars: int


def fill_stored_gaps(
    spark: SparkSession,
    table: str,
    landing: Callable[[DataFrame], DataFrame],
    work: str,
    expected_interval_minutes: int = 5,
    as_of: Column | None = None,
) -> StoredFill:
    """Fill the gaps of a stored intraday table (partitioned by month) until nothing more lands.

    ``landing`` gets the ranges to fetch (``ticker, range_start, range_end, dates``) and returns the bars it has for them so far, extra ones
    included; bars at missing timestamps are merged. The table is searched for gaps once. Every further round knows its
    gaps from the last round's gaps and bars, and rewrites only the months in which bars have landed. Bars with a null ticker or time fill nothing.

    ``work`` is a new folder that all executors reach; each round's gaps and bars are written there. A run that breaks
    off can be repeated with another folder: bars merged before are no longer missing. Every round but the last
    fills at least one missing bar, so the loop ends.
    """
    intraday_gaps(spark.read.parquet(table), expected_interval_minutes).write.parquet(f"{work}/gaps-0")
    rounds = bars = 0
    while True:
        gaps = spark.read.parquet(f"{work}/gaps-{rounds}")
        missing = missing_bars(gaps)
        landed = landing(fetch_ranges(missing)).join(missing.select("ticker", "timestamp"), ["ticker", "timestamp"], "left_semi")
        last_per_key(landed, INTRADAY_POLICY.key).write.parquet(f"{work}/bars-{rounds}")
        found = spark.read.parquet(f"{work}/bars-{rounds}")
        count = found.count()
        if not count:
            return StoredFill(gaps, rounds, bars)
        upsert_table(spark, table, found.withColumn("month", month_of("timestamp")), INTRADAY_POLICY, as_of=as_of)
        rounds, bars = rounds + 1, bars + count
        remaining_gaps(gaps, found, expected_interval_minutes).write.parquet(f"{work}/gaps-{rounds}")
