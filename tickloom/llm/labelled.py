"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_sample(labels: DataFrame, label: str, keep: Column, size: int, key: str = "doc_id") -> DataFrame:
    """At most ``size`` ids with their label, chosen by a hash of the id.

    ``keep`` says which labels may be learned from. Rows with a null id or label are left out, and an
    id that is labelled more than once counts once, with its largest label.
    """
    return (
        labels.where(keep & F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(key)
        .agg(F.max(F.col(label).cast("int")).alias("label"))
        .orderBy(F.xxhash64(F.col(key), F.lit(17)), key)
        .limit(size)
    )


def sampled_texts(documents: DataFrame, sample: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``label`` and ``text`` of the sampled ids; the sample's size is bounded, so it is broadcast."""
    ids = sample.select(F.col(key).alias("sample_id"), "label")
    texts = documents.select(F.col(key).alias("own_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids), F.col("own_id") == F.col("sample_id")).select("sample_id", "label", "text")
