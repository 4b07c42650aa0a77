"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes of the whole text; a chunk ends where it has enough zero bits: more of them
are asked for before the normal size than after it, so sizes stay near it (normalised chunking). Boundaries
depend on the last 32 bytes only, so an insertion or a cut changes the chunks around it and no others. A fingerprint is
the set of chunk digests with their lengths, and the likeness of two fingerprints is the length
of the chunks they share, as a part of the shorter one's length: 1 for a text that the other contains.

Defined results: a null text counts as empty; an empty text has an empty fingerprint, which is alike (1) to an
empty one and unlike (0) any other. Equal texts have equal fingerprints. A null id sorts before all others; rows that
repeat an id follow each other in the order of a hash of their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.rolling import SliceHashes

LEAST, NORMAL, MOST = 8, 32, 128
STRICT, LOOSE = np.uint32(63 << 26), np.uint32(15 << 28)
_GEAR = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) & 0xFFFFFFFF for b in range(256)], np.uint32)


def chunk_ends(raw: np.ndarray) -> list[int]:
    """Ends of the chunks of a byte array."""
    n = len(raw)
    h = _GEAR[raw]
    step = 1
    while step < 32 and step < n:
        h[step:] += h[:-step] << np.uint32(step)  # the right side is evaluated before it is added
        step *= 2
    places = np.flatnonzero(h & LOOSE == 0)
    strict = (h[places] & STRICT == 0).tolist()
    ends, start = [], 0
    for end, is_strict in zip((places + 1).tolist(), strict):
        size = end - start
        while size > MOST:
            start += MOST
            ends.append(start)
            size = end - start
        if size >= NORMAL or (is_strict and size >= LEAST):
            ends.append(end)
            start = end
    while n - start > MOST:
        start += MOST
        ends.append(start)
    if start < n:
        ends.append(n)
    return ends


def fingerprint(raw: bytes) -> dict[int, int]:
    """Length of each distinct chunk by its 32-bit digest."""
    a = np.frombuffer(raw, np.uint8)
    if not len(a):
        return {}
    ends = np.array(chunk_ends(a))
    starts = np.concatenate([[0], ends[:-1]])
    h = SliceHashes(a).of(starts, ends)
    return dict(zip((h >> np.uint64(32)).tolist(), (ends - starts).tolist()))


def written(chunks: dict[int, int]) -> str:
    """Ten hexadecimal digits per chunk, ascending: eight of the digest and two of the length."""
    return "".join(f"{d:08x}{n:02x}" for d, n in sorted(chunks.items()))


def parsed(text: str) -> dict[int, int]:
    return {int(text[i : i + 8], 16): int(text[i + 8 : i + 10], 16) for i in range(0, len(text), 10)}


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    """Shared length as a part of the shorter fingerprint's."""
    least = min(sum(a.values()), sum(b.values()))
    if not least:
        return 1.0 if len(a) == len(b) else 0.0
    return min(1.0, sum(n for d, n in a.items() if d in b) / least)


def with_fingerprint(documents: DataFrame, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of every whole text; a column of that name is replaced."""

    @F.pandas_udf("string")
    def made(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: written(fingerprint(t.encode("utf-8", "surrogatepass"))))

    return documents.withColumn(column, made(F.coalesce(F.col(text), F.lit(""))))


_FIRST = -(1 << 63)
_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_OUT_SQL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edited_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by bucket; in each bucket the rows by id, then the row that follows the bucket as a guest."""
    held = None  # bucket, id, text and chunks of the row before
    for batch in batches:
        rows = []
        for bucket, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            follows = held is not None and held[0] == bucket
            if guest and not follows:
                continue
            chunks = fingerprint(text.encode("utf-8", "surrogatepass"))
            if follows:
                _, own_id, own, own_chunks = held
                quarter = len(own) // 4
                edited = (own[: len(own) - quarter] + text[:quarter]).encode("utf-8", "surrogatepass")
                edited_chunks = fingerprint(edited)
                rows.append((own_id, len(own), hashlib.sha256(edited).hexdigest(), written(own_chunks), written(edited_chunks), likeness(own_chunks, edited_chunks), likeness(own_chunks, chunks)))
            held = None if guest else (bucket, doc_id, text, chunks)
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _OUT.types)], schema=_OUT)


def compared_with_edits(documents: DataFrame, key: str = "doc_id", text: str = "text", rows_per_bucket: int = 1_000, most_buckets: int = 20_000) -> DataFrame:
    """Fingerprint of every text and of its edited form, and how alike they and the next document are.

    The edited text has its last quarter replaced by the beginning of the next document by id. Documents are dealt
    into ranges of ids, and the first document of a range is also sent, as a guest, to the range before,
    so each text is shuffled once. The ranges' first ids (at most ``most_buckets`` numbers) are broadcast.
    """
    order = F.coalesce(F.col(key).cast("long"), F.lit(_FIRST))
    ids = documents.select(order.alias("place"))
    rows = ids.count()
    buckets = min(max(rows // rows_per_bucket, 64), most_buckets)
    at = F.percentile_approx("place", [i / buckets for i in range(1, buckets)], 10 * buckets)
    borders = np.unique(np.array(ids.agg(at.alias("borders")).first()["borders"] or [], np.int64))

    @F.pandas_udf("long")
    def bucket_of(places: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, places.to_numpy(), "right"))

    firsts = sorted((r["bucket"], r["place"]) for r in ids.groupBy(bucket_of("place").alias("bucket")).agg(F.min("place").alias("place")).collect())
    # The first document of each range visits the range before it; the very first one visits the last.
    visits = [(place, firsts[i - 1][0]) for i, (_, place) in enumerate(firsts)]
    spark = documents.sparkSession
    guests = spark.createDataFrame(visits, "first_place long, visited long") if visits else spark.createDataFrame([], "first_place long, visited long")
    source = documents.select(order.alias("place"), F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("bucket", bucket_of("place"))
    both = source.join(F.broadcast(guests), F.col("place") == F.col("first_place"), "left")
    stops = F.when(F.col("visited").isNull(), F.array(F.struct("bucket", F.lit(False).alias("guest")))).otherwise(
        F.array(F.struct("bucket", F.lit(False).alias("guest")), F.struct(F.col("visited").alias("bucket"), F.lit(True).alias("guest")))
    )
    dealt = both.select(F.explode(stops).alias("stop"), "place", "doc_id", "text").select("stop.bucket", "stop.guest", "place", "doc_id", "text")
    ordered = dealt.repartitionByRange("bucket").sortWithinPartitions("bucket", "guest", "place", F.xxhash64("text"))
    return ordered.select("bucket", "guest", "doc_id", "text").mapInArrow(_edited_rows, _OUT_SQL)
