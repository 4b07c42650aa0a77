"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. One pass over the documents normalises each whole text and keeps a narrow row (key, fingerprint,
   SHA-256, length). The same pass sends, for every chunk of a partition, its distinct fingerprints to
   their owners: sorted, as Golomb-Rice coded gaps. A fingerprint that a chunk holds many times is sent once, with a flag,
   so a text that makes up a third of all rows costs one code word per chunk.
2. An owner (one of many hash ranges, so of bounded size) decodes its runs and answers each chunk with a bitmap of
   which fingerprints are held more than once.
3. Rows whose bit is unset are finished. The others are suspects: their texts alone are shuffled and compared as
   bytes, by grouping on the normalised text itself; partial aggregation leaves one row per text and task.
   Of equal texts the longest original, then the smallest id, stays.

Chunks are numbered in the written narrow table, not by re-reading a partition, so a lost executor or another split
of the input can't mix them up.

Defined results: a null text counts as empty, and all empty texts are equal. Of equally
long originals a row without an id comes last. Rows repeated as a whole all name the same keep_id, and of
them exactly one is kept. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.storage import saved

SPACE = b" \t\n\x0b\x0c\r"
OWNER_BITS = 8  # ranges of fingerprints per owner row; see owners_for
CHUNK_ROWS = 16_384


def golomb_encode(sorted_values: np.ndarray, top: int) -> bytes:
    """Sorted distinct unsigned values below ``top``: Rice parameter, count, then unary quotients and remainder bits."""
    n = len(sorted_values)
    if not n:
        return b""
    gaps = np.diff(np.concatenate([[np.uint64(0)], sorted_values.astype(np.uint64)]))
    rice = max(0, int(top // n).bit_length() - 1)
    quotient = (gaps >> np.uint64(rice)).astype(np.int64)
    ends = np.cumsum(quotient + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    shifts = np.arange(rice, dtype=np.uint64)
    low = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
    head = np.array([rice, n, len(unary)], "<u4").tobytes()
    return head + np.packbits(unary, bitorder="little").tobytes() + np.packbits(low, bitorder="little").tobytes()


def golomb_decode(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    rice, n, length = (int(v) for v in np.frombuffer(data, "<u4", 3))
    unary_bytes = (length + 7) // 8
    unary = np.unpackbits(np.frombuffer(data, np.uint8, unary_bytes, 12), count=length, bitorder="little")
    quotient = np.diff(np.concatenate([[-1], np.flatnonzero(unary)])) - 1
    low = np.unpackbits(np.frombuffer(data, np.uint8, -1, 12 + unary_bytes), count=n * rice, bitorder="little").reshape(n, rice).astype(np.uint64)
    remainder = (low << np.arange(rice, dtype=np.uint64)).sum(1, dtype=np.uint64)
    return np.cumsum((quotient.astype(np.uint64) << np.uint64(rice)) + remainder, dtype=np.uint64)


_SENT = pa.schema(
    [
        ("chunk", pa.int64()), ("owner", pa.int32()), ("slot", pa.int32()), ("rid", pa.int64()), ("doc_id", pa.int64()),
        ("chars", pa.int64()), ("sha", pa.binary()), ("run", pa.binary()), ("local", pa.binary()),
    ]
)


def _chunk(task: int, number: int, ids: list, chars: list, fps: list, shas: list, owner_bits: int) -> list[pa.RecordBatch]:
    """Narrow rows of one chunk, and its coded runs by owner."""
    chunk = (task << 24) | number
    fp = np.array(fps, np.uint64)
    distinct, place, count = np.unique(fp, return_inverse=True, return_counts=True)
    shift = np.uint64(64 - owner_bits)
    owner = (distinct >> shift).astype(np.int32)
    first = np.searchsorted(owner, np.arange((1 << owner_bits) + 1))
    slot = np.arange(len(distinct)) - first[owner]
    n = len(fps)
    rows = pa.record_batch(
        [pa.array(np.full(n, chunk)), pa.array(owner[place]), pa.array(slot[place].astype(np.int32)), pa.array((np.int64(chunk) << 16) + np.arange(n)), pa.array(ids, pa.int64()), pa.array(chars, pa.int64()), pa.array(shas, pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
        schema=_SENT,
    )
    owners, runs, local = np.unique(owner), [], []
    for o in owners:
        part = slice(first[o], first[o + 1])
        runs.append(golomb_encode(distinct[part] & ((np.uint64(1) << shift) - np.uint64(1)), 1 << int(shift)))
        local.append(np.packbits(count[part] > 1, bitorder="little").tobytes())
    k = len(owners)
    sent = pa.record_batch(
        [pa.array(np.full(k, chunk)), pa.array(owners), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array(runs, pa.binary()), pa.array(local, pa.binary())],
        schema=_SENT,
    )
    return [rows, sent]


def normalised(raw: bytes) -> bytes:
    return raw.translate(None, SPACE)


def _send(owner_bits: int, chunk_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids, chars, fps, shas = [], [], [], []
        for batch in batches:
            for doc_id, text, length in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                raw = normalised(text.as_buffer().to_pybytes() if text.is_valid else b"")
                ids.append(doc_id)
                chars.append(length)
                fps.append(xxhash.xxh3_64_intdigest(raw))
                shas.append(hashlib.sha256(raw).digest())
                if len(ids) >= chunk_rows:
                    yield from _chunk(task, number, ids, chars, fps, shas, owner_bits)
                    number += 1
                    ids, chars, fps, shas = [], [], [], []
        if ids:
            yield from _chunk(task, number, ids, chars, fps, shas, owner_bits)

    return run


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Bitmaps of one owner: for every chunk, which of its fingerprints are held more than once anywhere."""
    runs = [golomb_decode(r) for r in pdf["run"]]
    flags = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(r), bitorder="little").astype(bool) for b, r in zip(pdf["local"], runs)]
    held = np.concatenate(runs)
    distinct, place, count = np.unique(held, return_inverse=True, return_counts=True)
    twice = count > 1
    twice[place[np.concatenate(flags)]] = True
    bits = np.split(twice[place], np.cumsum([len(r) for r in runs])[:-1])
    return pd.DataFrame({"chunk": pdf["chunk"], "owner": pdf["owner"], "bitmap": [np.packbits(b, bitorder="little").tobytes() for b in bits]})


def exact_groups(documents: DataFrame, key: str = "doc_id", text: str = "text", owner_bits: int = OWNER_BITS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per document: its group of equal texts and whether it is the one that stays.

    ``owner_bits`` sets the number of owners, 2**owner_bits; an owner holds about rows / 2**owner_bits
    fingerprints of eight bytes, so 20 bits suit 10**11 rows. ``chunk_rows`` is at most 65,536.
    """
    source = documents.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sent = saved(source.select("doc_id", F.col("text").cast("binary").alias("text"), F.char_length("text").cast("long").alias("chars")).mapInArrow(_send(owner_bits, min(chunk_rows, 65_536)), _spark_schema()), "fingerprints")
    rows = sent.where("rid is not null").select("rid", "chunk", "owner", "slot", "doc_id", "chars", "sha")
    answers = sent.where("run is not null").groupBy("owner").applyInPandas(_answer, "chunk long, owner int, bitmap binary")
    bit = F.expr("(conv(hex(substring(bitmap, slot div 8 + 1, 1)), 16, 10) >> (slot % 8)) & 1")
    told = saved(rows.join(answers, ["chunk", "owner"]).withColumn("suspect", bit == 1).select("rid", "chunk", "doc_id", "chars", "sha", "suspect"), "suspects")

    # Texts of suspects only, compared as bytes by grouping on them.
    suspects = told.where("suspect")
    ids = suspects.select(F.col("doc_id").alias("suspect_id")).distinct()
    texts = source.join(ids.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("suspect_id")), "left_semi")
    packed = F.translate(F.col("text"), SPACE.decode(), "")
    by_bytes = texts.groupBy(packed.alias("packed")).agg(F.count(F.lit(1)).alias("copies"))
    proven = by_bytes.groupBy(F.unhex(F.sha2(F.col("packed").cast("binary"), 256)).alias("sha")).agg(F.count(F.lit(1)).alias("texts"))

    # A group's best row and size, first within a chunk and then over all chunks.
    best = F.min(F.struct((-F.col("chars")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    local = suspects.groupBy("sha", "chunk").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
    groups = local.groupBy("sha").agg(F.min("best").alias("best"), F.sum("n").alias("n")).join(proven, "sha")
    checked = F.assert_true(F.col("texts") == 1, F.lit("different texts with the same SHA-256"))
    named = local.select("sha", "chunk").join(groups.where(checked.isNull()), "sha").select("sha", "chunk", "best", "n")
    out = told.join(named, ["sha", "chunk"], "left")
    return out.select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("best.rid") == F.col("rid"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _spark_schema() -> str:
    return "chunk long, owner int, slot int, rid long, doc_id long, chars long, sha binary, run binary, local binary"


def drop_exact_copies(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    A row stays if its id and normalised text are those of a kept row. Where several rows have one id, those
    that also share the text are reduced to one. A null id is an id like any other; further columns may have any name.
    """
    groups = saved(exact_groups(documents, key, text).select(F.col("doc_id").alias("group_id"), "kept", "text_sha256"), "exact-groups")
    repeated = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group_id")
    digest = F.sha2(F.translate(F.coalesce(F.col(text), F.lit("")), SPACE.decode(), "").cast("binary"), 256)
    rows = documents.select(F.col(key).cast("long").alias("own_id"), digest.alias("own_digest"), F.struct(*documents.columns).alias("row"))
    same_id = F.col("own_id").eqNullSafe(F.col("group_id"))
    # Shuffled whatever the size is: the copies grow with the input, so they are never broadcast.
    single = rows.join(groups.where("not kept").hint("shuffle_hash"), same_id, "left_anti").join(repeated, same_id, "left_anti")
    kept = groups.where("kept").join(repeated.withColumnRenamed("group_id", "repeated_id"), F.col("group_id").eqNullSafe(F.col("repeated_id")), "left_semi")
    many = rows.join(kept, same_id & (F.col("own_digest") == F.col("text_sha256")), "left_semi").dropDuplicates(["own_id", "own_digest"])
    return single.unionByName(many).select("row.*")
