"""What the physical plans look like."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tickloom.operators import market
from tickloom.plans.daily import confluence_table
from tickloom.plans.intraday import recent_bars
from tickloom.registry import views
from tickloom.sources.tables import scan_daily_bars


def plan_of(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "bars")
    views.bars_daily(spark, SMALL).write.parquet(path)
    return path


def test_features_never_group_by_ticker_alone(spark, stored):
    """Rows are grouped by bucket and slice; what is grouped by ticker alone is one row per bucket or slice."""
    text = plan_of(confluence_table(spark.read.parquet(stored)))
    by_ticker = re.findall(r"Exchange hashpartitioning\((_key_0#\d+), \d+\)[^\n]*\n([^\n]*\n[^\n]*)", text)
    assert by_ticker
    for _, below in by_ticker:
        # Counts per bucket, or the single edge row of each slice.
        assert "HashAggregate" in below or "_own_" in below
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoop"):
        assert word not in text


def test_filters_and_columns_reach_the_scan(spark, stored):
    text = plan_of(scan_daily_bars(spark.read.parquet(stored), "1-URGENT").select("date", "close"))
    assert "EqualTo(ticker,1-URGENT)" in text
    assert re.search(r"ReadSchema: struct<ticker:string,date:date,close:double>", text)


def test_history_cutoff_reaches_the_scan(spark, tmp_path):
    import datetime as dt

    path = str(tmp_path / "bars")
    views.bars_intraday(spark, SMALL).write.parquet(path)
    text = plan_of(recent_bars(spark.read.parquet(path), dt.date(2026, 1, 10), 2))
    assert "GreaterThanOrEqual(timestamp" in text


def test_merge_reads_only_touched_partitions_once(spark, tmp_path, monkeypatch):
    from tickloom.operators import upsert

    path = str(tmp_path / "table")
    bars = views.bars_daily(spark, SMALL).withColumn("month", upsert.month_of("date"))
    bars.write.partitionBy("month").parquet(path)
    batch = spark.read.parquet(path).filter("month = '1995-02'").withColumn("close", F.col("close") + 1)
    batch = spark.createDataFrame(batch.collect(), batch.schema)
    plans, merge = [], upsert.merge_batch
    monkeypatch.setattr(upsert, "merge_batch", lambda base, *a: plans.append(plan_of(merged := merge(base, *a))) or merged)
    upsert.upsert_table(spark, path, batch, upsert.DAILY_POLICY)
    assert plans[0].count("FileScan parquet") == 1
    assert re.search(r"PartitionFilters: \[[^\]]*1995-02", plans[0])


@pytest.mark.parametrize("name", ["daily_features", "news_daily", "intraday_features", "gap_summary", "combined_sentiment"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan_of(queries()[name](spark, SMALL))
    for word in ("ArrowEval", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoop"):
        assert word not in text


def test_index_is_joined_before_the_rows_are_wide(spark, stored):
    bars = spark.read.parquet(stored)
    index = market.index_returns(views.index_daily(spark, SMALL))
    text = plan_of(confluence_table(bars, index=index))
    assert text.index("Window") < text.index("Join")  # the join lies below all windows


def test_export_lets_a_reader_skip_files(spark, tmp_path):
    from tickloom.sources.sinks import write_clustered

    bars, path = views.bars_daily(spark, SMALL), str(tmp_path / "out")
    write_clustered(bars, path, ("ticker", "date"), rows_per_file=200)
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        F.min("ticker").alias("a"), F.max("ticker").alias("b"), F.count("*").alias("n")
    ).collect()
    assert sum(f.n for f in files) == bars.count() and max(f.n for f in files) <= 200
    # Only files whose range holds the ticker can have its rows; ranges meet at their ends only.
    with_it = [f for f in files if f.a <= "2-HIGH" <= f.b]
    assert 0 < len(with_it) < len(files)
    assert sum(f.a != f.b for f in files) < bars.select("ticker").distinct().count()
