"""Missing bars: calendar gaps, intraday gaps, boundary rows, fetch ranges."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import flag, require_columns
from .panel import Block, LastKnown, Panel, Step, run_blocks

# Market holidays of the default calendar.
HOLIDAYS = (
    date(2023, 12, 25),
    date(2024, 1, 1),
    date(2024, 1, 15),
    date(2024, 2, 19),
    date(2024, 3, 29),
    date(2024, 5, 27),
    date(2024, 9, 2),
    date(2025, 1, 20),
    date(2025, 2, 17),
    date(2025, 4, 18),
    date(2025, 5, 26),
    date(2025, 7, 4),
    date(2025, 9, 1),
)
# Day limits of daily gaps, and the two closed-market gaps in seconds.
GAP_DAYS_ALLOWED = 3
HOLIDAY_GAP_DAYS = 4
WEEKEND_GAP_SECONDS = 201900
OVERNIGHT_GAP_SECONDS = 29100

RANGE_GAP_DAYS = 7
# Bars per row while a gap is being listed; no limit on its length.
GAP_PIECE = 4096


def calendar_columns(time: Column) -> dict[str, Column]:
    """Monday and Friday flags of a date or UTC timestamp."""
    return {"is_monday": flag(F.weekday(time) == 0), "is_friday": flag(F.weekday(time) == 4)}


class DayDistance(Block):
    """Days since the previous bar, 0 for the first."""

    def first(self, panel: Panel) -> dict[str, str]:
        return {"days_since_prev_close": f"coalesce(datediff(date, {panel.lag('date')}), 0)"}

    def columns(self) -> list[str]:
        return ["days_since_prev_close"]


class SecondDistance(Block):
    """Whole seconds since the previous bar, 0 for the first."""

    def first(self, panel: Panel) -> dict[str, str]:
        micros = f"unix_micros(timestamp) - unix_micros({panel.lag('timestamp')})"
        return {"seconds_since_prev_bar": f"coalesce(({micros}) DIV 1000000, 0)"}

    def columns(self) -> list[str]:
        return ["seconds_since_prev_bar"]


class Previous(Block):
    """Time of the previous bar."""

    def __init__(self, time: str, name: str):
        self.time, self.name = time, name

    def first(self, panel: Panel) -> dict[str, str]:
        return {self.name: panel.lag(self.time)}

    def columns(self) -> list[str]:
        return [self.name]


class Boundary(Block):
    """Flags of the first and last bar of each ticker."""

    def first(self, panel: Panel) -> dict[str, str]:
        return {
            "missing_next_bar": f"CASE WHEN {panel.is_last} THEN 1 ELSE 0 END",
            "missing_previous_bar": f"CASE WHEN {panel.is_first} THEN 1 ELSE 0 END",
        }

    def columns(self) -> list[str]:
        return ["missing_next_bar", "missing_previous_bar"]


class RangeStart(Block):
    """First date of the run of dates that lie at most ``max_gap_days`` apart."""

    def __init__(self, max_gap_days: int):
        self.max_gap_days = max_gap_days

    def first(self, panel: Panel) -> dict[str, str]:
        opens = f"{panel.is_first} OR datediff(date, {panel.lag('date')}) > {self.max_gap_days}"
        return {"_opens": f"CASE WHEN {opens} THEN date END"}

    def scans(self, panel: Panel) -> list[Step]:
        return [LastKnown("range_start", "_opens")]

    def columns(self) -> list[str]:
        return ["range_start"]


def _holiday_inside(gaps: DataFrame, holidays: Sequence[date] | DataFrame) -> DataFrame:
    """Gaps without those that span a weekday holiday."""
    long_enough = F.col("gap_days") >= HOLIDAY_GAP_DAYS
    if isinstance(holidays, DataFrame):
        # Days of the long gaps, matched to the calendar by date: an equi-join.
        after, before = F.date_add("previous_date", 1), F.date_add("current_date", -1)
        days = gaps.filter(long_enough).select(
            "ticker", "current_date", F.explode(F.sequence(after, before)).alias("holiday")
        )
        closed = (
            days.filter(F.weekday("holiday") < 5)
            .join(holidays.select("holiday").distinct(), "holiday", "left_semi")
            .select("ticker", "current_date")
            .distinct()
        )
        return gaps.join(closed, ["ticker", "current_date"], "left_anti")
    weekdays = [F.lit(day) for day in holidays if day.weekday() < 5]
    if not weekdays:
        return gaps
    spanned = F.exists(
        F.array(*weekdays), lambda day: (day > F.col("previous_date")) & (day < F.col("current_date"))
    )
    return gaps.filter(~(long_enough & spanned))


def daily_gaps(bars: DataFrame, holidays: Sequence[date] | DataFrame = HOLIDAYS) -> DataFrame:
    """Steps of more than three days between bars of a ticker, holidays excepted."""
    require_columns(bars, ("ticker", "date"), "daily_gaps")
    gaps = run_blocks(bars.select("ticker", "date"), Previous("date", "previous_date")).select(
        "ticker",
        "previous_date",
        F.col("date").alias("current_date"),
        F.datediff("date", "previous_date").alias("gap_days"),
    )
    return _holiday_inside(gaps.filter(F.col("gap_days") > GAP_DAYS_ALLOWED), holidays)


def intraday_gaps(bars: DataFrame, expected_interval_minutes: int = 5) -> DataFrame:
    """Steps longer than 1.5 intervals, the two usual closed-market steps
    excepted, with the first, the last and the number of the bars missing inside;
    :func:`missing_bars` lists them."""
    require_columns(bars, ("ticker", "timestamp"), "intraday_gaps")
    times = run_blocks(
        bars.select("ticker", "timestamp"), Previous("timestamp", "previous_timestamp"), order="timestamp"
    )
    return _long_steps(times, expected_interval_minutes)


def _long_steps(times: DataFrame, expected_interval_minutes: int) -> DataFrame:
    """Gaps among the steps (ticker, previous_timestamp, timestamp)."""
    seconds = (F.unix_micros("timestamp") - F.unix_micros("previous_timestamp")) / 1e6
    step = F.expr(f"interval {int(expected_interval_minutes)} minutes")
    steps = times.select(
        "ticker",
        "previous_timestamp",
        F.col("timestamp").alias("current_timestamp"),
        (seconds / 60).alias("gap_minutes"),
        seconds.alias("gap_seconds"),
    )
    gaps = steps.filter(
        (F.col("gap_minutes") > expected_interval_minutes * 1.5)
        & ~F.col("gap_seconds").isin(float(WEEKEND_GAP_SECONDS), float(OVERNIGHT_GAP_SECONDS))
    )
    micros = int(expected_interval_minutes) * 60_000_000
    inside = F.unix_micros("current_timestamp") - F.unix_micros("previous_timestamp") - 1
    counted = gaps.withColumn("missing_count", F.floor(inside / micros).cast("int"))
    span = F.timestamp_micros(F.unix_micros("previous_timestamp") + F.col("missing_count").cast("long") * F.lit(micros).cast("long"))
    return counted.withColumns({"first_missing": F.col("previous_timestamp") + step, "last_missing": span})


def remaining_gaps(gaps: DataFrame, filled: DataFrame, expected_interval_minutes: int = 5) -> DataFrame:
    """The gaps left once the ``filled`` bars, all inside gaps, are in the table.

    Only the bounds of the gaps and the filled bars are ordered, never the table: a step
    that starts at the first bound of a gap or at a filled bar lies inside a gap, any other leads from one gap to the next.
    """
    one, none = F.lit(1), F.lit(0)
    times = (
        gaps.select("ticker", F.col("previous_timestamp").alias("timestamp"), one.alias("_inside"))
        .unionByName(gaps.select("ticker", F.col("current_timestamp").alias("timestamp"), none.alias("_inside")))
        .unionByName(filled.select("ticker", "timestamp", one.alias("_inside")))
        .groupBy("ticker", "timestamp")
        .agg(F.max("_inside").alias("_inside"))
    )
    steps = run_blocks(times, Previous("timestamp", "previous_timestamp"), Previous("_inside", "_starts_inside"), order="timestamp")
    return _long_steps(steps.filter(F.col("_starts_inside") == 1), expected_interval_minutes)


def flag_missing_neighbors(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars with boundary flags, and the table of the flagged ones."""
    flagged = run_blocks(bars, Boundary(), order="timestamp")
    return flagged, neighbor_table(flagged)


def neighbor_table(flagged: DataFrame) -> DataFrame:
    at_boundary = (F.col("missing_next_bar") == 1) | (F.col("missing_previous_bar") == 1)
    return flagged.filter(at_boundary).select(
        "ticker", "timestamp", "missing_previous_bar", "missing_next_bar"
    )


def missing_bars(gaps: DataFrame) -> DataFrame:
    """One row per missing timestamp, counted up from the bounds of its gap.

    A long gap is first cut into pieces, so no row holds a list that grows with it.
    """
    micros = F.expr("(unix_micros(first_missing) - unix_micros(previous_timestamp))")
    pieces = gaps.select(
        "ticker",
        F.unix_micros("previous_timestamp").alias("_from"),
        micros.alias("_step"),
        "missing_count",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("missing_count") - 1) / GAP_PIECE))).alias("_piece"),
    )
    last = F.least(F.col("missing_count").cast("long"), (F.col("_piece") + 1) * GAP_PIECE)
    numbered = pieces.select("ticker", "_from", "_step", F.explode(F.sequence(F.col("_piece") * GAP_PIECE + 1, last)).alias("_k"))
    return numbered.select("ticker", F.timestamp_micros(F.col("_from") + F.col("_k") * F.col("_step")).alias("timestamp")).withColumn("date", F.to_date("timestamp"))


def fetch_ranges(missing: DataFrame, max_gap_days: int = RANGE_GAP_DAYS) -> DataFrame:
    """Dates of a ticker packed into ranges; dates up to a week apart share one."""
    dates = missing.select("ticker", "date").distinct()
    return (
        run_blocks(dates, RangeStart(max_gap_days))
        .groupBy("ticker", "range_start")
        .agg(F.max("date").alias("range_end"), F.count(F.lit(1)).alias("dates"))
    )


def gap_summary(gaps: DataFrame) -> DataFrame:
    """Gaps and missing bars per ticker, with the first and the last missing bar."""
    return gaps.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("gaps"),
        F.sum("missing_count").alias("missing_bars"),
        F.min("first_missing").alias("first_missing"),
        F.max("last_missing").alias("last_missing"),
    )


def history_cutoff(as_of: date | Column, max_years_back: int) -> Column:
    """First date kept when going back whole years of 365 days."""
    start = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.date_sub(start, 365 * max_years_back)


@dataclass(frozen=True)
class GapFill:
    """Result of filling intraday gaps from a landing table."""

    bars: DataFrame
    ranges: DataFrame
    summary: DataFrame


def fill_gaps(
    gaps: DataFrame, landed: DataFrame, as_of: date | Column | None = None, max_years_back: int | None = None
) -> GapFill:
    """Landed bars at missing timestamps, the ranges to fetch, and the counts.

    A range for which nothing has landed counts as an error. With
    ``max_years_back`` dates before that many years from ``as_of`` are skipped and counted.

    The counts come from one table of the missing and landed bars per ticker and day.
    """
    missing = missing_bars(gaps)
    recent = missing
    if max_years_back is not None:
        recent = missing.filter(F.col("date") >= history_cutoff(as_of, max_years_back))
    bars = landed.join(recent.select("ticker", "timestamp"), ["ticker", "timestamp"], "left_semi")
    ranges = fetch_ranges(recent)

    # Every missing and landed bar once, then days: what is missing, what has landed, what fits.
    marked = missing.select("ticker", "timestamp", F.lit(1).alias("_missing"), F.lit(0).alias("_landed")).unionByName(
        landed.select("ticker", "timestamp", F.lit(0).alias("_missing"), F.lit(1).alias("_landed"))
    )
    each = marked.groupBy("ticker", "timestamp").agg(F.sum("_missing").alias("m"), F.sum("_landed").alias("l"))
    days = each.groupBy("ticker", F.to_date("timestamp").alias("date")).agg(
        F.max(F.col("m") > 0).alias("lacks"),
        F.max(F.col("l") > 0).alias("landed"),
        F.sum(F.when(F.col("m") > 0, F.col("l")).otherwise(0)).alias("bars"),
    )
    keeps = F.lit(True) if max_years_back is None else F.col("date") >= history_cutoff(as_of, max_years_back)
    lacking = days.filter(F.col("lacks") & keeps)
    placed = run_blocks(lacking.select("ticker", "date", "bars"), RangeStart(RANGE_GAP_DAYS))
    # A range is served by any landed day inside it, lacking or not.
    bounds = placed.groupBy("ticker", "range_start").agg(F.max("date").alias("range_end"), F.count(F.lit(1)).alias("dates"), F.sum("bars").alias("bars"))
    covered = bounds.select("ticker", "range_start", F.explode(F.sequence("range_start", "range_end")).alias("date"))
    served = covered.join(days.filter("landed").select("ticker", "date"), ["ticker", "date"], "left_semi").select("ticker", "range_start").distinct()
    report = bounds.join(served.withColumn("_served", F.lit(True)), ["ticker", "range_start"], "left").agg(
        F.coalesce(F.sum("dates"), F.lit(0)).alias("dates_processed"),
        F.coalesce(F.sum("bars"), F.lit(0)).alias("bars_inserted"),
        F.count(F.when(F.col("_served").isNull(), 1)).alias("errors"),
    )
    old = days.filter(F.col("lacks") & ~keeps).agg(F.count_distinct("date").alias("skipped_old"))
    summary = report.withColumn("_one", F.lit(1)).join(old.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return GapFill(bars, ranges, summary)
