"""The join of hot keys."""

from pyspark.sql import functions as F

from tickloom.llm.skew import lookup_join
from tickloom.llm.storage import saved


def test_hot_keys_are_found_in_few_jobs(spark):
    many = saved(spark.range(3_000).select(F.when(F.col("id") < 1_200, 0).otherwise(F.col("id") % 50).alias("key"), "id"), "many")
    one = spark.range(40).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    set_to = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {name: spark.conf.get(name) for name in set_to}
    for name, value in set_to.items():
        spark.conf.set(name, value)
    spark.sparkContext.setJobGroup("hot-keys", "")
    try:
        joined = lookup_join(many, one, "key", rows=1_000)
        # an iterator over the counted keys took a job for each of the 60 partitions
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("hot-keys")) < 12
        got = {(r.id, r.key, r.twice) for r in joined.collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for name, value in old.items():
            spark.conf.set(name, value)
    keys = {i: 0 if i < 1_200 else i % 50 for i in range(3_000)}
    assert got == {(i, k, 2 * k) for i, k in keys.items() if k < 40}
