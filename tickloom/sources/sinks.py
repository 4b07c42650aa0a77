"""Parquet output."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# A hundred feature columns of doubles make about a gigabyte of this many rows before compression.
ROWS_PER_FILE = 1_000_000


def persist_if_requested(df: DataFrame, path: str | None, partition_by: str | None = None) -> DataFrame:
    """Write the frame when a path is given (also when it has no rows) and return it."""
    if path:
        writer = df.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df


def persist_counted(df: DataFrame, path: str | None) -> tuple[DataFrame, int | None]:
    """Write the frame when a path is given; return what was written, read back, and its number of rows.

    The rows are counted by the tasks that write them, so neither the count nor later use of the frame computes it again.
    Without a path the frame comes back as it is, and the number is unknown.
    """
    if not path:
        return df, None
    rows = Observation()
    persist_if_requested(df.observe(rows, F.count(F.lit(1)).alias("rows")), path)
    return df.sparkSession.read.schema(df.schema).parquet(path), rows.get["rows"]


def write_clustered(df: DataFrame, path: str, by: tuple[str, ...], rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write files that each hold one range of the ``by`` columns, sorted, and at most ``rows_per_file`` rows.

    A reader of one key then skips files and row groups by their statistics. Ranges split a key of any size, as long as ``by``
    goes on to the time. Columns the frame lacks are left out.
    """
    order = [c for c in by if c in df.columns]
    if not order:
        raise ValueError(f"write_clustered needs one of the columns {by}; input has {df.columns}")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
