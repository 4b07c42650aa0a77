"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, as in tests, a folder of this machine, which only a local session can use."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named or _own_folder()


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage with files that outlive any executor. The caller's plan reads
    what was written, so a nondeterministic step before it is evaluated once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tables/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """Text of a row; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def crc_fold(key: str, folds: int) -> Column:
    """crc32 of the key's decimal text modulo ``folds``; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def with_row_key(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Add ``k1`` and ``k2``, equal only for rows of equal id and equal text.

    Rows that repeat another one share its key, so whatever is found about a key holds for all of them.
    """
    return df.withColumns(
        {
            "k1": F.xxhash64(F.coalesce(F.col(id_column).cast("string"), F.lit("null"))),
            "k2": F.xxhash64(F.coalesce(F.col(text_column), F.lit("")), F.lit(1)),
        }
    )
