"""A stored merge writes few files, and the index learns the partition of the row that stays."""

import os

from pyspark.sql import functions as F

from tickloom.operators.upsert import KeyIndex, MergePolicy, last_per_key, partition_of_last, upsert_table

POLICY = MergePolicy(("id",), ("value",))


def test_one_file_per_small_partition(spark, tmp_path):
    made = spark.range(400).select(F.col("id").cast("string").alias("id"), F.lit(0).alias("value"), F.format_string("m%02d", F.col("id") % 10).alias("month"))
    made.repartition("month").write.partitionBy("month").parquet(f"{tmp_path}/table")
    index = KeyIndex(f"{tmp_path}/index", ("id",), buckets=2)
    index.build(made)
    # the batch dates known rows to other months, which must not move them, and adds others
    batch = spark.range(200, 800).repartition(4).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("value"), F.format_string("m%02d", F.col("id") % 20).alias("month"))
    # tables below the broadcast threshold would be coalesced into one task
    for name, value in (kept := {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}).items():
        spark.conf.set(name, value)
    try:
        upsert_table(spark, f"{tmp_path}/table", batch, POLICY, index=index)
    finally:
        for name in kept:
            spark.conf.unset(name)
    files = {d: sum(f.endswith(".parquet") for f in fs) for d, _, fs in os.walk(f"{tmp_path}/table") if "month=" in d}
    assert len(files) == 20 and set(files.values()) == {1}
    got = {(r.id, r.value, r.month) for r in spark.read.parquet(f"{tmp_path}/table").collect()}
    assert got == {(str(i), int(i >= 200), f"m{i % (10 if i < 400 else 20):02d}") for i in range(800)}


def test_partition_of_last_is_that_of_the_whole_row(spark):
    rows = [("a", 1, "x"), ("a", 2, "w"), ("b", 1, "x"), ("b", 1, "x"), ("c", 3, None), ("c", 2, "y"), ("d", None, None), (None, 1, "x"), (None, 2, "u")]
    batch = spark.createDataFrame(rows, "id string, value int, month string")
    for frame in (batch, batch.where("id IN ('b', 'd')")):
        wanted = {(r.id, r.month) for r in last_per_key(frame, ["id"]).collect()}
        assert {(r.id, r.month) for r in partition_of_last(frame, ["id"], "month").collect()} == wanted
        again = frame.withColumn("turn", -F.coalesce("value", F.lit(0)))
        wanted = {(r.id, r.month) for r in last_per_key(again, ["id"], "turn").collect()}
        assert {(r.id, r.month) for r in partition_of_last(again, ["id"], "month", "turn").collect()} == wanted
