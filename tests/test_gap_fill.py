"""A stored table is filled round by round until nothing more lands."""

import datetime as dt
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from tickloom.operators.quality import intraday_gaps, missing_bars, remaining_gaps
from tickloom.operators.upsert import month_of
from tickloom.plans.backfill import fill_stored_gaps

SCHEMA = "ticker string, timestamp timestamp, open double, high double, low double, close double, volume long, transactions long, volume_weighted_avg_price double"
START = dt.datetime(2024, 1, 31, 22, 0, tzinfo=dt.timezone.utc)


def bars(spark, steps, ticker="A", close=1.0):
    rows = [(ticker, START + dt.timedelta(minutes=5 * k), 1.0, 1.0, 1.0, close, 1, 1, 1.0) for k in steps]
    return spark.createDataFrame(rows, SCHEMA)


def stored(spark, rows):
    root = f"{spark.conf.get('spark.checkpoint.dir')}/{uuid4().hex}"
    rows.withColumn("month", month_of("timestamp")).write.partitionBy("month").parquet(f"{root}/table")
    return root


def listed(df):
    return sorted(tuple(r) for r in df.select("ticker", "previous_timestamp", "current_timestamp", "missing_count", "first_missing", "last_missing").collect())


def test_remaining_gaps_equal_a_new_search(spark, layout):
    table = bars(spark, [0, 1, 6, 7, 40, 41, 300]).union(bars(spark, [0, 3, 9, 400], "B")).union(bars(spark, [5], None))
    gaps = intraday_gaps(table)
    every = missing_bars(gaps).withColumn("k", F.unix_seconds("timestamp") / 300)
    for chosen in (F.lit(False), F.col("k") % 3 == 0, F.col("k") % 7 != 0, F.lit(True)):
        filled = every.filter(chosen).select("ticker", "timestamp")
        again = intraday_gaps(table.select("ticker", "timestamp").union(filled))
        assert listed(remaining_gaps(gaps, filled)) == listed(again)


def test_rounds_until_nothing_lands(spark):
    root = stored(spark, bars(spark, [0, 1, 6, 100]))
    # In reach from the first call on, from the second on, never.
    source = bars(spark, [2, 1], close=2.0), bars(spark, [2, 3, 60, 60, 61], close=3.0)
    asked = []

    def landing(ranges):
        asked.append(sorted((r.ticker, r.range_start, r.range_end) for r in ranges.collect()))
        return source[min(len(asked), 2) - 1]

    done = fill_stored_gaps(spark, f"{root}/table", landing, f"{root}/work")
    assert (done.rounds, done.bars, len(asked)) == (2, 4, 3)
    table = {(r.timestamp - START.replace(tzinfo=None)) // dt.timedelta(minutes=5): r.close for r in spark.read.parquet(f"{root}/table").collect()}
    # The bar that was there keeps its values, and so does one that landed before.
    assert table == {0: 1.0, 1: 1.0, 2: 2.0, 3: 3.0, 6: 1.0, 60: 3.0, 61: 3.0, 100: 1.0}
    assert listed(done.gaps) == listed(intraday_gaps(spark.read.parquet(f"{root}/table")))


def test_only_months_with_landed_bars_are_rewritten(spark):
    root = stored(spark, bars(spark, [0, 4, 100, 104]))
    months = {r[0]: r[1] for r in spark.read.parquet(f"{root}/table").select("month", F.input_file_name()).distinct().collect()}
    assert len(months) == 2
    done = fill_stored_gaps(spark, f"{root}/table", lambda _: bars(spark, [102]), f"{root}/work")
    after = {r[0]: r[1] for r in spark.read.parquet(f"{root}/table").select("month", F.input_file_name()).distinct().collect()}
    assert done.bars == 1 and after["2024-01"] == months["2024-01"] and after["2024-02"] != months["2024-02"]


@pytest.mark.parametrize("steps", [[], [0], [0, 1, 2]])
def test_nothing_missing(spark, steps):
    root = stored(spark, bars(spark, [7, 8]).union(bars(spark, steps, "B")))
    done = fill_stored_gaps(spark, f"{root}/table", lambda _: bars(spark, [1, 2, 3], None), f"{root}/work")
    assert (done.rounds, done.bars, done.gaps.count()) == (0, 0, 0)


def test_repeat_after_a_break(spark):
    root = stored(spark, bars(spark, [0, 6]))

    def breaks(_):
        raise RuntimeError("source is gone")

    with pytest.raises(RuntimeError):
        fill_stored_gaps(spark, f"{root}/table", breaks, f"{root}/work-1")
    calls = []

    def lands_then_breaks(_):
        calls.append(1)
        if len(calls) > 1:
            raise RuntimeError("source is gone")
        return bars(spark, [1, 2])

    with pytest.raises(RuntimeError):
        fill_stored_gaps(spark, f"{root}/table", lands_then_breaks, f"{root}/work-2")
    done = fill_stored_gaps(spark, f"{root}/table", lambda _: bars(spark, [1, 2, 3, 4, 5]), f"{root}/work-3")
    assert done.bars == 3 and spark.read.parquet(f"{root}/table").count() == 7
