"""Queries over the given tables, one for each operator of this subpackage, and the SQL some are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.conversation_trie import conversation_trie
from tickloom.llm.fingerprints import compared_with_edits
from tickloom.llm.golomb_dedup import exact_groups
from tickloom.llm.license_scan import LEAST, TEMPLATES, license_scan
from tickloom.llm.packing import packed_sequences
from tickloom.llm.quality_gam import fit_quality, quality_scores
from tickloom.llm.secret_scan import secret_scan
from tickloom.llm.setsketch_dedup import near_components
from tickloom.llm.spelling import spelling_groups, word_counts
from tickloom.llm.sql_parts import SPELLING, TRIE
from tickloom.llm.storage import crc_fold, saved
from tickloom.llm.suffix_dedup import PASSAGE_BYTES, without_repeats
from tickloom.llm.toxicity import fit_toxicity, toxicity_scores
from tickloom.llm.unigram import round_trip
from tickloom.llm.warc import capture_history, write_archives

QUALITY_KEPT_FROM = 0.3
TOXIC_FROM = 0.7


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    fold = crc_fold("doc_id", 5)
    model = fit_quality(documents, table(spark, folder, "labels"), fold != 0)
    return quality_scores(documents.select("doc_id", "text"), model).select(
        "doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= QUALITY_KEPT_FROM).cast("int").alias("predicted")
    )


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"))


def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_components(table(spark, folder, "documents"), threshold=0.85)


def edits(spark: SparkSession, folder: str) -> DataFrame:
    return compared_with_edits(table(spark, folder, "documents"))


def repeats(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    cut = without_repeats(documents, passages=PASSAGE_BYTES)
    return cut.select("others.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("left").alias("text"), "n_passages", "n_passage_bytes")


def unigram(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


#: Documents as files of a tree: short ones are the notices of their folder, the shortest those of the folder above.
FILE_PATH = """
    CASE WHEN n_chars <= 200 THEN concat('/', source, '/', lang, '/NOTICE.', doc_id)
         WHEN n_chars <= 400 THEN concat('/', source, '/', lang, '/', doc_id // 1000, '/LICENSE.', doc_id)
         ELSE concat('/', source, '/', lang, '/', doc_id // 1000, '/', doc_id) END
"""


def licenses(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "documents").select(F.expr(FILE_PATH.replace("//", "div")).alias("path"), "text")
    return license_scan(files).select(F.regexp_extract("path", "[0-9]+$", 0).cast("long").alias("doc_id"), "path", "license", "score", F.col("source").alias("origin"))


def packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return packed_sequences(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = write_archives(table(spark, folder, "pages"))
    return capture_history(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_groups(saved(word_counts(table(spark, folder, "documents")), "words"))


def secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan(table(spark, folder, "documents"))


def trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie(table(spark, folder, "conversations"))


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    fold = crc_fold("doc_id", 3)
    model = fit_toxicity(documents, table(spark, folder, "labels"), fold != 1)
    return toxicity_scores(documents.select("doc_id", "text"), model).select(
        "doc_id", (fold == 1).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_gam": quality,
    "op2_exact_dedup": exact_dedup,
    "op3_setsketch_dedup": near_dedup,
    "op4_fingerprints": edits,
    "op5_toxicity": toxicity,
    "op6_suffix_dedup": repeats,
    "op7_unigram": unigram,
    "op8_packing": packing,
    "op9_license_scan": licenses,
    "op10_warc": warc,
    "op11_spelling": spelling,
    "op12_secrets": secrets,
    "op13_conversation_trie": trie,
}

_TEMPLATE_ROWS = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES)
_SPLIT_WORDS = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda w: w <> '')"

ORACLE: dict[str, str] = {
    "op11_spelling": SPELLING,
    "op13_conversation_trie": TRIE,
    "op9_license_scan": rf"""
        WITH files AS (SELECT {FILE_PATH} AS path, coalesce(text, '') AS text FROM documents),
        units AS (SELECT path, row_number() OVER () AS u, unit FROM (SELECT path, unnest(string_split_regex(text, '\n|[.!?]\s+')) AS unit FROM files) WHERE unit <> ''),
        words AS (SELECT path, u, unnest({_SPLIT_WORDS.format("unit")}) AS word FROM units),
        tf AS (SELECT path, u, word, count(*) AS tf FROM words GROUP BY ALL),
        t AS (SELECT license, word, count(*) AS tf FROM (SELECT license, unnest({_SPLIT_WORDS.format("notice")}) AS word FROM (VALUES {_TEMPLATE_ROWS}) AS v(license, notice)) GROUP BY ALL),
        n AS (SELECT count(*) AS n FROM units),
        idf AS (SELECT word, ln((1 + any_value(n)) / (1 + count(tf.u))) + 1 AS idf FROM (SELECT DISTINCT word FROM t) LEFT JOIN tf USING (word), n GROUP BY word),
        weights AS (SELECT license, word, t.tf * idf / sqrt(sum((t.tf * idf) ** 2) OVER (PARTITION BY license)) AS weight FROM t JOIN idf USING (word)),
        weighed AS (SELECT path, u, word, tf, idf FROM tf LEFT JOIN idf USING (word)),
        size AS (SELECT u, sqrt(sum(CASE WHEN idf IS NULL THEN tf * (ln(1 + n) + 1) ** 2 ELSE (tf * idf) ** 2 END)) AS size FROM weighed, n GROUP BY u),
        scored AS (SELECT path, license, round(sum(tf * idf * weight) / any_value(size), 6) AS score FROM weighed JOIN weights USING (word) JOIN size USING (u) GROUP BY path, u, license),
        own AS (SELECT path, license, score FROM scored WHERE score >= {LEAST} QUALIFY row_number() OVER (PARTITION BY path ORDER BY score DESC, license) = 1),
        folders AS (SELECT *, regexp_replace(path, '/?[^/]*$', '') AS folder FROM (SELECT DISTINCT path FROM files)),
        speaking AS (
            SELECT folder AS ancestor, license, score FROM own JOIN folders USING (path) WHERE regexp_matches(path, '/(LICENSE|NOTICE)[^/]*$')
            QUALIFY row_number() OVER (PARTITION BY folder ORDER BY score DESC, license) = 1
        ),
        nearest AS (
            SELECT f.folder, s.license, s.score FROM (SELECT DISTINCT folder FROM folders) f JOIN speaking s ON f.folder = s.ancestor OR starts_with(f.folder, s.ancestor || '/')
            QUALIFY row_number() OVER (PARTITION BY f.folder ORDER BY length(s.ancestor) DESC) = 1
        )
        SELECT regexp_extract(path, '[0-9]+$')::BIGINT AS doc_id, path, coalesce(own.license, nearest.license) AS license, coalesce(own.score, nearest.score) AS score,
               CASE WHEN own.license IS NOT NULL THEN 'own' WHEN nearest.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin
        FROM folders LEFT JOIN own USING (path) LEFT JOIN nearest USING (folder)
    """,
    "op2_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS packed
            FROM documents
        )
        SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY packed) AS group_size,
               first_value(doc_id) OVER best = doc_id AS kept, sha256(packed) AS text_sha256
        FROM t WINDOW best AS (PARTITION BY packed ORDER BY chars DESC, doc_id)
    """,
    "op10_warc": """
        WITH t AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS h FROM pages),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS newest FROM t)
        SELECT page_id, payload_bytes,
               translate(
                   to_base(('0x' || h[1:10])::BIGINT, 32, 8) || to_base(('0x' || h[11:20])::BIGINT, 32, 8)
                   || to_base(('0x' || h[21:30])::BIGINT, 32, 8) || to_base(('0x' || h[31:40])::BIGINT, 32, 8),
                   '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'
               ) AS payload_digest,
               CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> newest THEN newest END AS refers_to
        FROM g
    """,
}
