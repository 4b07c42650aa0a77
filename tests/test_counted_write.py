"""Rows are counted by the tasks that write them."""

from uuid import uuid4

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tickloom.plans.daily import prepare_daily_features
from tickloom.plans.intraday import prepare_intraday_features
from tickloom.registry import views
from tickloom.sources.sinks import persist_counted
from tickloom.sources.tables import MarketTables


def new_path(spark):
    return f"{spark.conf.get('spark.checkpoint.dir')}/{uuid4().hex}"


def jobs(spark, work):
    group = uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        result = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("rows", [0, 1, 1000])
def test_one_job_and_one_evaluation(spark, rows):
    evaluated = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            evaluated.add(len(batch))
            yield batch

    table = spark.range(rows).mapInPandas(seen, "id long")
    _, plain = jobs(spark, lambda: table.write.parquet(new_path(spark)))
    assert evaluated.value == rows
    (kept, count), counted = jobs(spark, lambda: persist_counted(table, new_path(spark)))
    assert (count, counted) == (rows, plain) and evaluated.value == 2 * rows
    assert sorted(r.id for r in kept.collect()) == list(range(rows)) and evaluated.value == 2 * rows


def test_without_a_path(spark):
    table = spark.range(3)
    kept, count = persist_counted(table, None)
    assert kept is table and count is None


def test_plans_tell_what_they_saved(spark):
    daily = prepare_daily_features(MarketTables(views.bars_daily(spark, SMALL)), ["1-URGENT"], new_path(spark))
    assert daily.rows == daily.features.count() > 0
    assert daily.features.select(F.count_distinct("ticker")).first()[0] == 1
    intraday = prepare_intraday_features(MarketTables(intraday=views.bars_intraday(spark, SMALL)), None, new_path(spark))
    assert intraday.rows == intraday.features.count() > 0
    assert prepare_intraday_features(MarketTables(intraday=views.bars_intraday(spark, SMALL))).rows is None
