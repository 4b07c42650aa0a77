"""Bad landing records: found, set aside with a reason, and reported to their chunk.

A record is bad when it is not valid JSON of the landing schema or when the table could not hold it. The first reason
that applies, in this order, is given: ``corrupt record``, ``missing <field>``, ``out of range <field>``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LANDING_BARS, LANDING_NEWS
from .landing import bars_from_landing, news_from_landing

_CORRUPT = "_corrupt_record"
_PRICES = ("open", "high", "low", "close", "vwap")
# A DECIMAL(12, 4) holds numbers below this.
_PRICE_LIMIT = 1e8
# Milliseconds of the years 1 to 9999.
_FIRST_MS, _LAST_MS = -62135596800000, 253402300799999


@dataclass(frozen=True)
class Checked:
    """``good`` rows in the shape of the table, and ``bad`` records: ``record, reason, ticker, day``.

    Ticker and day are null where the record does not tell them; a corrupt record tells neither. Columns of the
    input asked for by ``keep`` follow in both.
    """

    good: DataFrame
    bad: DataFrame


def _bar_rules() -> list[tuple[str, Column]]:
    missing = [(f"missing {n}", F.col(f"r.{n}").isNull()) for n in ("ticker", "timestamp", "open", "high", "low", "close")]
    time = [("out of range timestamp", ~F.col("r.timestamp").between(_FIRST_MS, _LAST_MS))]
    # NaN is larger than any number, so it is out of range too.
    return missing + time + [(f"out of range {n}", ~(F.abs(F.round(F.col(f"r.{n}"), 4)) < _PRICE_LIMIT)) for n in _PRICES]


def _news_rules() -> list[tuple[str, Column]]:
    score = F.round(F.get("r.insights", F.lit(0))["score"], 2)
    return [
        *[(f"missing {n}", F.col(f"r.{n}").isNull()) for n in ("id", "ticker", "published_utc")],
        ("out of range published_utc", F.try_to_timestamp("r.published_utc").isNull()),
        ("out of range score", ~score.between(-1.0, 1.0)),
    ]


def _checked(lines: DataFrame, text: str, schema: T.StructType, rules: list, time: Column, keep: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Records with their parsed form ``r``: good ones, and bad ones with reason, ticker and day."""
    whole = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = lines.select(F.col(text).alias("record"), F.from_json(text, whole, {"columnNameOfCorruptRecord": _CORRUPT}).alias("r"), *keep)
    corrupt = F.col("r").isNull() | F.col(f"r.{_CORRUPT}").isNotNull()
    reason = F.when(corrupt, "corrupt record")
    for name, broken in rules:
        reason = reason.when(broken, name)
    told = parsed.withColumn("reason", reason)
    bad = told.filter(F.col("reason").isNotNull()).select(
        "record",
        "reason",
        F.when(~corrupt, F.col("r.ticker")).alias("ticker"),
        F.when(~corrupt, F.to_date(time)).alias("day"),
        *keep,
    )
    return told.filter(F.col("reason").isNull()).select(*[f"r.{n}" for n in schema.names], *keep), bad


def check_landed_bars(lines: DataFrame, text: str = "value", with_date: bool = False, keep: tuple[str, ...] = ()) -> Checked:
    """Split bar records, one JSON text per row, into rows of the bar table and bad records.

    Ticker, time and the four prices must be there, prices must fit into the table's decimals and the time into a
    timestamp. Volume, transactions and the average price may be missing. A null or empty text is corrupt.
    """
    at = F.col("r.timestamp")
    time = F.when(at.between(_FIRST_MS, _LAST_MS), F.timestamp_millis(at))
    good, bad = _checked(lines, text, LANDING_BARS, _bar_rules(), time, keep)
    return Checked(bars_from_landing(good, with_date, keep), bad)


def check_landed_news(lines: DataFrame, text: str = "value", only_with_insights: bool = True) -> Checked:
    """The same for news: id, ticker and a readable time must be there, and the first insight's score in [-1, 1]."""
    good, bad = _checked(lines, text, LANDING_NEWS, _news_rules(), F.try_to_timestamp("r.published_utc"), ())
    return Checked(news_from_landing(good, only_with_insights), bad)


def failed_chunks(bad: DataFrame, plan: DataFrame) -> DataFrame:
    """Chunks of a plan that got a bad record, with a message: the ``failures`` of a backfill.

    The backfill merges nothing of them and writes ``failed`` to the ledger, so they are fetched again. Records
    without ticker or day belong to no chunk and stay in the quarantine only. Records are counted per ticker and
    day before the join, so a chunk may have any number of them.
    """
    chunk = ["ticker", "start_date", "end_date"]
    days = plan.filter(F.col("start_date") <= F.col("end_date")).select(*chunk, F.explode(F.sequence("start_date", "end_date")).alias("day"))
    counted = bad.filter(F.col("ticker").isNotNull() & F.col("day").isNotNull()).groupBy("ticker", "day").agg(F.count(F.lit(1)).alias("_n"), F.min("reason").alias("_reason"))
    found = days.join(counted, ["ticker", "day"]).groupBy(*chunk).agg(F.sum("_n").alias("_n"), F.min("_reason").alias("_reason"))
    message = F.concat(F.col("_n").cast("string"), F.lit(" bad records, among them: "), F.col("_reason"))
    return found.select(*chunk, message.alias("error_message"))
