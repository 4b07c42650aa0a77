"""A text pipeline: quality, exact copies, near copies, repeated passages, packing.

Each stage works on all that its predecessor kept. The result is one row per packed piece. No SQL can
express the whole (a fitted model and a tokenizer are in it); the tests hold every stage against a brute-force version.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.golomb_dedup import drop_exact_copies
from tickloom.llm.packing import packed_sequences
from tickloom.llm.quality_gam import fit_quality, quality_scores
from tickloom.llm.registry import QUALITY_KEPT_FROM
from tickloom.llm.setsketch_dedup import near_components
from tickloom.llm.storage import saved, shared_folder
from tickloom.llm.suffix_dedup import PASSAGE_BYTES, without_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is not rejected."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))
    return quality_scores(docs, model, score="quality_score").where(F.col("quality_score") >= QUALITY_KEPT_FROM).select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_copies(docs).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the smallest id, of each group of near copies (similarity 0.8 or more).

    Rows are told apart by a number of their own, as ids may be null or repeated. Blank texts are no copies of each other.
    """
    rows = saved(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "near-rows")
    found = near_components(rows, key="row").select(F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    grouped = rows.select("row", "doc_id").join(found, "row").groupBy("component")
    kept = saved(grouped.agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")).select("first.row"), "near-kept")
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of strings of ``PASSAGE_BYTES`` that occur more than once; n_chars follows the text."""
    cut = without_repeats(docs.select(*COLUMNS), PASSAGE_BYTES)
    return cut.select("others.doc_id", F.col("left").alias("text"), "others.lang", "others.source", F.char_length("left").cast(docs.schema["n_chars"].dataType).alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024 ids: one row per piece of a document."""
    import public_tokenizers

    return packed_sequences(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("near dedup", near), ("suffix-array dedup", passages), ("best-fit packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; every stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
