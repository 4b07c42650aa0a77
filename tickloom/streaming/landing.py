"""Resumable ingest of landing files with Structured Streaming.

Each micro-batch of new files is merged like a batch load. Progress is kept in the
stream's own checkpoint, so a restart continues where the last run ended, and a
batch that is applied twice leaves the table as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import INTRADAY_POLICY, MergePolicy, last_per_key, month_of, upsert_table
from ..schemas import LANDING_BARS
from ..sources.landing import bars_from_landing


SEQUENCE = "_sequence"


def arrival() -> Column:
    """Order in which files landed, by their time and name; records of a micro-batch add their place in the file."""
    return F.struct(*[F.col(f"_metadata.{name}") for name in ("file_modification_time", "file_name", "file_block_start")])


def _table_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def merge_into(path: str, policy: MergePolicy, batch: DataFrame) -> None:
    """Merge one micro-batch into the table, creating it on the first one."""
    spark = batch.sparkSession
    time = next(c for c in policy.key if c in ("date", "timestamp"))
    placed = F.struct(F.col(SEQUENCE).alias("file"), F.monotonically_increasing_id().alias("place"))
    batch = batch.withColumns({"month": month_of(time), SEQUENCE: placed})
    if _table_exists(spark, path):
        upsert_table(spark, path, batch, policy, sequence=SEQUENCE)
    else:
        last_per_key(batch, policy.key, SEQUENCE).write.partitionBy("month").parquet(path)


def ingest_bars(
    spark: SparkSession, landing: str, table: str, progress: str, policy: MergePolicy = INTRADAY_POLICY
) -> StreamingQuery:
    """Merge all landing files that have not been merged yet, then stop.

    ``progress`` is a folder all executors can reach; of two records of one bar, the one that landed later wins.
    """
    source = spark.readStream.schema(LANDING_BARS).json(landing).withColumn(SEQUENCE, arrival())
    bars = bars_from_landing(source, with_date="date" in policy.key, keep=(SEQUENCE,))
    if "date" in policy.key:
        bars = bars.drop("timestamp")

    def apply(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            merge_into(table, policy, batch)

    return (
        bars.writeStream.foreachBatch(apply)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
