"""Small tables with everything that may go wrong in them."""

from pyspark.sql import types as T

LONG = "word " * 30_000
CLASHES = ("label", "score", "owner", "bin", "k1", "key", "group_id", "kept", "text_sha256", "own_id", "row", "word", "spans", "digest")
DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASHES]
)
TEXTS = [
    (1, "The same text, twice."), (2, "The  same text,\ttwice. "), (3, None), (4, ""), (5, " \n\t"), (6, LONG), (7, LONG), (8, LONG + "tail"), (9, "x"),
    (10, "a b c d e"), (11, "a b c d e f"), (12, "ünïcödé \U0001f600 text ▁ with marks " * 20), (13, "The same text, twice."), (14, None), (None, "text without an id"), (None, None),
    (9, "x"), (9, "another text of document nine"), (15, "<|endoftext|> spelled out"), (16, "De " * 700),
]


def documents(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *["clash"] * len(CLASHES)) for i, t in rows], DOCUMENTS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
