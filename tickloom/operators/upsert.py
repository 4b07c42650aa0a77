"""Merging a batch into a table without duplicate keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import require_columns


@dataclass(frozen=True)
class MergePolicy:
    """Key of a table and the columns a matching row takes from the batch; the
    others keep the value they have."""

    key: tuple[str, ...]
    replaced: tuple[str, ...]


_BAR_VALUES = ("open", "high", "low", "close", "volume", "transactions", "volume_weighted_avg_price")
DAILY_POLICY = MergePolicy(("ticker", "date"), _BAR_VALUES)
INTRADAY_POLICY = MergePolicy(("ticker", "timestamp"), _BAR_VALUES)
NEWS_POLICY = MergePolicy(
    ("id",),
    (
        "title",
        "description",
        "sentiment_score",
        "sentiment_label",
        "sentiment_reasoning",
        "keywords",
        "tickers",
    ),
)


def last_per_key(batch: DataFrame, key: Sequence[str], sequence: str | Column | None = None) -> DataFrame:
    """One row per key: the one with the highest ``sequence``. Reduced before the shuffle.

    Rows of one key and sequence, and all rows of a key when no sequence is given, go
    by their values in column order, so the result never depends on how the batch is split into tasks.
    """
    order = F.col(sequence) if isinstance(sequence, str) else sequence
    rest = [c for c in batch.columns if c not in key and c != sequence]
    row = F.struct(*rest)
    ranked = F.max(F.struct(*([] if order is None else [order.alias("_sequence")]), row.alias("_row")))
    kept = batch.groupBy(*key).agg(ranked.alias("_last"))
    return kept.select(*key, *[F.col("_last._row")[c].alias(c) for c in rest])


def partition_of_last(batch: DataFrame, key: Sequence[str], partition: str, sequence: str | None = None) -> DataFrame:
    """Key and ``partition`` of the rows of ``last_per_key``; whole rows are compared only for keys whose rows differ in the partition."""
    known, rows = F.count(partition), F.count(F.lit(1))
    ends = batch.groupBy(*key).agg(
        F.min(partition).alias("_least"), ((known == 0) | (known == rows) & (F.min(partition) == F.max(partition))).alias("_settled")
    )
    one = ends.where("_settled").select(*key, F.col("_least").alias(partition))
    mixed = ends.where("NOT _settled").select(*[F.col(k).alias(f"_mixed_{k}") for k in key])
    if mixed.isEmpty():
        return one
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_mixed_{k}")) for k in key])
    return one.unionByName(last_per_key(batch.join(mixed, same, "left_semi"), key, sequence).select(*key, partition))


def _aligned(frame: DataFrame, like: DataFrame) -> DataFrame:
    """Columns and types of ``like``; columns the frame lacks are null."""
    have = set(frame.columns)
    return frame.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields]
    )


def merge_batch(
    base: DataFrame,
    batch: DataFrame,
    policy: MergePolicy,
    as_of: Column | None = None,
    sequence: str | None = None,
) -> DataFrame:
    """Rows of ``base`` updated by the batch, then the rows the batch adds.

    One full join on the key, so either side is read once.
    ``created_at``/``updated_at`` are maintained when the base has them.
    """
    key = list(policy.key)
    require_columns(batch, (*key, *policy.replaced), "merge_batch")
    now = F.current_timestamp() if as_of is None else as_of
    fresh = _aligned(last_per_key(batch, key, sequence), base)
    names = [c for c in base.columns if c not in key]
    incoming = fresh.select(*key, *[F.col(c).alias(f"_new_{c}") for c in names], F.lit(True).alias("_fresh"))
    joined = base.withColumn("_stored", F.lit(True)).join(incoming, key, "full_outer")
    both, only_new = F.col("_fresh") & F.col("_stored"), F.col("_stored").isNull()

    def merged(name: str) -> Column:
        if name in key:
            return F.col(name)
        old, new = F.col(name), F.col(f"_new_{name}")
        if name == "created_at":
            return F.when(only_new, now).otherwise(old)
        if name == "updated_at":
            return F.when(F.col("_fresh"), now).otherwise(old)
        return F.when(both if name in policy.replaced else F.lit(False), new).when(only_new, new).otherwise(old)

    types = {f.name: f.dataType for f in base.schema.fields}
    return joined.select(*[merged(c).cast(types[c]).alias(c) for c in base.columns])


def news_defaults(articles: DataFrame) -> DataFrame:
    """Fill the columns an incoming article may lack."""
    have = set(articles.columns)
    nothing = F.array().cast("array<string>")

    def filled(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in have else default

    text = F.col("text") if "text" in have else F.lit(None).cast("string")
    described = F.when(filled("description", F.lit("")) != "", filled("description", F.lit("")))
    return articles.withColumns(
        {
            "title": filled("title", F.lit("")),
            "description": F.coalesce(described, text, F.lit("")),
            "url": filled("url", F.lit("")),
            "author": filled("author", F.lit("")),
            "type": filled("type", F.lit("article")),
            "keywords": filled("keywords", nothing),
            "tickers": filled("tickers", nothing),
            **{
                c: F.lit(None).cast("string")
                for c in ("sentiment_label", "sentiment_reasoning")
                if c not in have
            },
            **({} if "sentiment_score" in have else {"sentiment_score": F.lit(None).cast("double")}),
        }
    ).drop("text")


def month_of(time: str) -> Column:
    """Partition value of a row in the stored tables."""
    return F.date_format(F.col(time), "yyyy-MM")


@dataclass(frozen=True)
class KeyIndex:
    """Stored table from a key to the partition its row was stored in, for tables whose key does not fix the partition.

    It is partitioned by a hash of the key, so a batch reads only the buckets of its own keys. The number of buckets belongs to
    the stored index and must stay the same; a bucket of a large table should hold about a million keys.
    """

    path: str
    key: tuple[str, ...]
    partition: str = "month"
    buckets: int = 64

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        return rows.select(*self.key, F.col(self.partition).cast("string").alias(self.partition)).withColumn("key_bucket", bucket)

    def build(self, table: DataFrame) -> None:
        """Index all rows of a table."""
        self._bucketed(table).repartition(self.buckets, "key_bucket").write.partitionBy("key_bucket").parquet(self.path)

    def of_keys(self, batch: DataFrame) -> DataFrame:
        """Index rows of the batch's keys."""
        wanted = self._bucketed(batch)
        touched = [row[0] for row in wanted.select("key_bucket").distinct().collect()]
        index = batch.sparkSession.read.schema(wanted.schema).parquet(self.path).where(F.col("key_bucket").isin(touched))
        return index.join(wanted.select(*self.key).distinct(), list(self.key), "left_semi").select(*self.key, self.partition)

    def add(self, batch: DataFrame, known: DataFrame) -> None:
        """Index the batch's keys that are not among the known ones."""
        new = self._bucketed(batch).dropDuplicates(list(self.key)).join(known, list(self.key), "left_anti")
        new.repartition("key_bucket").write.mode("append").partitionBy("key_bucket").parquet(self.path)


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    policy: MergePolicy,
    partition: str = "month",
    as_of: Column | None = None,
    sequence: str | None = None,
    key_fixes_partition: bool = True,
    index: KeyIndex | None = None,
) -> None:
    """Merge a batch into a Parquet table partitioned by ``partition``.

    The touched partition values are listed first (a batch spans a few months), so
    only those partitions are read, once, and rewritten. Time fixes the
    partition of a bar. Where the key does not (news: an article keeps the month it was
    stored in), ``index`` tells the partitions of the batch's keys; without one the key and partition columns of the
    whole table are searched. New keys are indexed before the table is written, so a run that breaks off can be
    repeated: an indexed key that is not in the table yet is just not found.

    The write replaces partition by partition: a reader may see some of them new and others old while it runs.
    """
    key = list(policy.key)
    base = spark.read.parquet(path)
    base = base.withColumn(partition, F.col(partition).cast("string"))
    touched = batch.select(partition)
    if index is not None:
        known = index.of_keys(batch)
        touched = touched.union(known.select(partition))
        index.add(partition_of_last(batch, key, partition, sequence), known)
    elif not key_fixes_partition:
        touched = touched.union(base.select(*key, partition).join(batch.select(*key).distinct(), key, "left_semi").select(partition))
    values = [row[0] for row in touched.distinct().collect()]
    known = [v for v in values if v is not None]
    within = F.col(partition).isin(known) if known else F.lit(False)
    # Rows without a partition value (an unparsed time) have a partition of their own, which equals nothing.
    affected = base.where(within | F.col(partition).isNull() if None in values else within)
    merged = merge_batch(affected, batch, policy, as_of, sequence)
    # The join deals rows by their key, so without this every task would write a file into every partition.
    (
        merged.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
