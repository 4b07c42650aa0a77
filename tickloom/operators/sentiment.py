"""Lexicon sentiment of articles and its mix with the vendor's score."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import require_columns
from ..functions.lexicon import NEGATIVE_WORDS, POSITIVE_WORDS, lexicon_score, sentiment_label, words_of


def _with_rule(
    df: DataFrame, text: Column, positive_words: Iterable[str], negative_words: Iterable[str]
) -> DataFrame:
    # The words are a column of their own, so a text is split once.
    scored = df.withColumn("_words", words_of(text)).withColumn(
        "sentiment_rule_score", lexicon_score(F.col("_words"), positive_words, negative_words)
    )
    return scored.drop("_words").withColumn("sentiment_rule_label", sentiment_label(F.col("sentiment_rule_score")))


def rule_sentiment(
    df: DataFrame,
    text_column: str = "description",
    positive_words: Iterable[str] = POSITIVE_WORDS,
    negative_words: Iterable[str] = NEGATIVE_WORDS,
) -> DataFrame:
    """Add ``sentiment_rule_score`` and ``sentiment_rule_label``."""
    require_columns(df, (text_column,), "rule_sentiment")
    return _with_rule(df, F.col(text_column), positive_words, negative_words)


def combine_sentiment_scores(
    df: DataFrame,
    *,
    positive_words: Iterable[str] = POSITIVE_WORDS,
    negative_words: Iterable[str] = NEGATIVE_WORDS,
    text_column: str = "description",
    use_title: bool = False,
    combine_title_description: bool = True,
) -> DataFrame:
    """Mean of the lexicon and vendor scores that are present, with a new label.

    The scored text is ``title. description`` by default; without both columns or
    with the option off it is the title (``use_title``) or ``text_column``. The
    vendor's own score is kept as ``sentiment_vendor_score``. Where the text
    column is absent only the vendor's score counts, and without that 0.
    """
    text = None
    if combine_title_description and {"title", "description"} <= set(df.columns):
        text = F.concat(
            F.coalesce(F.col("title"), F.lit("")), F.lit(". "), F.coalesce(F.col("description"), F.lit(""))
        )
    elif use_title and "title" in df.columns:
        text = F.col("title")
    elif text_column in df.columns:
        text = F.col(text_column)

    parts = []
    if text is not None:
        df = _with_rule(df, text, positive_words, negative_words)
        parts.append(F.col("sentiment_rule_score"))
    if "sentiment_score" in df.columns:
        df = df.withColumn("sentiment_vendor_score", F.col("sentiment_score"))
        parts.append(F.col("sentiment_vendor_score").cast("double"))
    if not parts:
        return df.withColumns({"sentiment_score": F.lit(0.0), "sentiment_label": F.lit("neutral")})

    present = sum((F.when(p.isNotNull(), 1).otherwise(0) for p in parts), F.lit(0))
    total = sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0))
    df = df.withColumn("sentiment_score", F.try_divide(total, present.cast("double")))
    return df.withColumn("sentiment_label", sentiment_label(F.col("sentiment_score")))
