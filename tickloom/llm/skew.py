"""Joins of many rows with one row per key, where a key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a key from which it counts as hot: at least this many, and at least this share of all rows. So a table has
#: 1 / share hot keys at most, which bounds the table of hot keys that joins may broadcast.
HOT_ROWS = 1_000
HOT_SHARE = 0.001


def lookup_join(many: DataFrame, one: DataFrame, key: str, how: str = "inner", rows: int | None = None, share: float = HOT_SHARE, counted: DataFrame | None = None) -> DataFrame:
    """Join on ``key``, unique in ``one``; rows of hot keys are dealt over several tasks, with a copy of their one row in each.

    The columns are those of ``many``, then the others of ``one``. ``how``: inner or left. Null keys meet nothing.
    ``many`` should be a stored table, as it is read twice; ``counted`` (key, _rows) spares one of these readings where the counts are known.
    """
    if counted is None:
        counted = many.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    each = max(HOT_ROWS if rows is None else rows, int(many.count() * share))
    # fewer than 1 / share rows, in one job: an iterator runs a job for each partition, however empty
    hot = [(row[key], -(-row["_rows"] // each)) for row in counted.where(F.col("_rows") > each).collect()]
    kind = many.schema[key].dataType.simpleString()
    spread = F.broadcast(many.sparkSession.createDataFrame(hot, f"`{key}` {kind}, _salts int"))
    others = [F.col(c) for c in many.columns if c != key]
    dealt = many.join(spread, key, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*others), F.col("_salts")), F.lit(0)).cast("int"))
    copied = one.join(spread, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
    return dealt.drop("_salts").join(copied.drop("_salts"), [key, "_salt"], how).select(*many.columns, *[c for c in one.columns if c != key])
