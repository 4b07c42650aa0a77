"""Word-count sentiment of a text as a column expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default word lists and label threshold.
POSITIVE_WORDS = (
    "beat",
    "growth",
    "bullish",
    "surge",
    "optimistic",
    "outperform",
    "rally",
    "upgrade",
    "profit",
    "record",
    "strong",
    "positive",
)
NEGATIVE_WORDS = (
    "miss",
    "loss",
    "bearish",
    "drop",
    "pessimistic",
    "underperform",
    "selloff",
    "downgrade",
    "decline",
    "weak",
    "negative",
    "lawsuit",
)
LABEL_THRESHOLD = 0.1


# Fixed value: white space as Python's str.split sees it.
_SPACE = r"(?U)[\s\x1c-\x1f]+"


def words_of(text: Column) -> Column:
    """Lower-case words between white space; punctuation stays attached."""
    return F.filter(F.split(F.lower(text), _SPACE), lambda t: t != "")


def lexicon_score(
    words: Column,
    positive: Iterable[str] = POSITIVE_WORDS,
    negative: Iterable[str] = NEGATIVE_WORDS,
) -> Column:
    """(positive words - negative words) / sqrt(words); 0 without words.
    A word in both lists counts as positive."""
    good = sorted({w.lower() for w in positive})
    bad = sorted({w.lower() for w in negative} - set(good))

    def counted(total: Column, word: Column) -> Column:
        step = F.when(word.isin(good), 1) if good else F.when(F.lit(False), 1)
        return total + (step.when(word.isin(bad), -1) if bad else step).otherwise(0)

    balance = F.aggregate(words, F.lit(0), counted).cast("double")
    return F.coalesce(F.try_divide(balance, F.sqrt(F.size(words).cast("double"))), F.lit(0.0))


def sentiment_label(score: Column) -> Column:
    return (
        F.when(score > LABEL_THRESHOLD, F.lit("positive"))
        .when(score < -LABEL_THRESHOLD, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )
