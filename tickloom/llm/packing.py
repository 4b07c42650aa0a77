"""Best-fit packing of tokenised documents by hierarchical residual packing.

A document becomes its token ids and an end mark. One longer than a sequence is cut into full sequences behind a shorter
first piece; full pieces are sequences of their own at once. All other pieces are packed in rounds:

* round 0: every partition packs its own pieces by best fit, largest first. A bin that is full up to ``slack``
  tokens is done;
* round r: the underfull bins of ``fan_in`` neighbouring groups meet as items, whole bins with one size each,
  and are packed by best fit again, until one group is left.

Only (bin, size) rows travel in the rounds, and each round has far fewer of them than the one
before, since all but a few of a group's bins leave it nearly full. A group
with more than ``most_items`` items is split, so no task grows with the input.

Defined results: a null or empty text is the end mark alone. Repeated rows are packed one by one. The number of
sequences may exceed the least possible; the tests bound it against total / capacity and first-fit decreasing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.storage import saved

CAPACITY = 1024
END_MARK = 2


@cache
def _exact(tokenizer_file: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file)


@cache
def _fast(ranks_file: str):
    """Encoder of the same vocabulary for texts without special tokens, about three times as fast."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str, tokenizer_file: str, ranks_file: str | None) -> list[int]:
    """Ids as the tokenizer gives them; its special tokens keep their ids where a text spells them out."""
    if ranks_file is None or "<|" in text:
        return _exact(tokenizer_file).encode(text, add_special_tokens=False).ids
    return _fast(ranks_file).encode_ordinary(text)


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each item, largest items first, each into the fullest bin that still takes it."""
    bins = np.zeros(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by space left
    spaces = 0  # bit s: some bin has s left
    number = 0
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        fitting = spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            b = open_bins[space].pop()
            if not open_bins[space]:
                spaces &= ~(1 << space)
        else:
            space, b = capacity, number
            number += 1
        bins[k] = b
        left = space - size
        open_bins[left].append(b)
        spaces |= 1 << left
    return bins


def _placed(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the filling of each bin."""
    bins = best_fit(sizes, capacity)
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(sizes[order])
    fill = np.bincount(bins, weights=sizes, minlength=0).astype(np.int64)
    offsets = np.empty(len(sizes), np.int64)
    offsets[order] = ends - sizes[order] - (np.cumsum(fill) - fill)[bins[order]]
    return bins, offsets, fill


_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("bin", pa.int64()), ("place", pa.int64()), ("fill", pa.int64())]
)
_PIECES_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, bin long, place long, fill long"


def _pack_partition(tokenizer_file: str, ranks_file: str | None, capacity: int, end_mark: int, keep_ids: bool, most_items: int):
    def pieces_of(text: str) -> Iterator[tuple[int, int, bytes]]:
        ids = np.array([*token_ids(text, tokenizer_file, ranks_file), end_mark], "<u4")
        first = len(ids) % capacity or capacity
        start = 0
        for piece, stop in enumerate(range(first, len(ids) + 1, capacity)):
            yield piece, start, ids[start:stop].tobytes()
            start = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal base, rows
            length = np.array([len(r[3]) // 4 for r in rows], np.int64)
            bins, place, fill = _placed(length, capacity)
            out = pa.record_batch(
                [
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64()), pa.array(length),
                    pa.array([crc32(r[3]) for r in rows], pa.int64()), pa.array([r[3] if keep_ids else None for r in rows], pa.binary()), pa.array(bins + base), pa.array(place), pa.array(fill[bins]),
                ],
                schema=_PIECES,
            )
            base += len(fill)
            rows = []
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += [(doc_id, *piece) for piece in pieces_of(text)]
                if len(rows) >= most_items:
                    yield flush()
        if rows:
            yield flush()

    return run


def _merge(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin", kind="stable")
        bins, place, fill = _placed(pdf["fill"].to_numpy(np.int64), capacity)
        # A new bin takes the number of its first item, so numbers stay distinct.
        first = pdf["bin"].groupby(bins).transform("min")
        return pd.DataFrame({"bin": pdf["bin"].to_numpy(), "next_bin": first.to_numpy(), "next_place": place, "next_fill": fill[bins]})

    return run


def packed_sequences(
    documents: DataFrame, tokenizer_file: str, ranks_file: str | None = None, capacity: int = CAPACITY, end_mark: int = END_MARK, key: str = "doc_id", text: str = "text",
    keep_ids: bool = False, slack: int = 0, fan_in: int = 8, most_items: int = 50_000,
) -> DataFrame:
    """One row per piece: document, piece number and start, length, checksum, sequence and offset there.

    ``ranks_file`` names the tokenizer's vocabulary as ranks, for the faster encoder; the ids are the same.
    With ``keep_ids`` the ids come along as little-endian unsigned 32-bit numbers.
    """
    source = documents.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    pack = _pack_partition(tokenizer_file, ranks_file, capacity, end_mark, keep_ids, most_items)
    pieces = saved(source.mapInArrow(pack, _PIECES_SQL), "pieces")
    rank = F.shiftright("bin", 36)
    level = pieces.where(F.col("fill") < capacity - slack).groupBy("bin").agg(F.first("fill").alias("fill"))
    moves = None
    groups = max(1, pieces.select(F.max(rank)).first()[0] or 0) + 1
    width = 1
    while True:
        width *= fan_in
        # Neighbours meet; a group of too many items is split by a hash of the bin.
        level = saved(level.withColumn("group", (F.shiftright("bin", 36) / width).cast("long")), "underfull")
        sizes = level.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / most_items).alias("parts"))
        dealt = level.join(sizes, "group").withColumn("part", F.pmod(F.xxhash64("bin"), F.col("parts")))
        step = saved(dealt.groupBy("group", "part").applyInPandas(_merge(capacity), "bin long, next_bin long, next_place long, next_fill long"), "merged")
        moves = step if moves is None else _followed(moves, step)
        if width >= groups:
            break
        level = step.where(F.col("next_fill") < capacity - slack).groupBy(F.col("next_bin").alias("bin")).agg(F.first("next_fill").alias("fill"))
    moved = moves.select(F.col("bin").alias("old"), "next_bin", "next_place")
    out = pieces.join(moved, F.col("bin") == F.col("old"), "left")
    return out.select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("next_bin", "bin").alias("sequence_id"), (F.coalesce("next_place", F.lit(0)) + F.col("place")).cast("long").alias("offset"),
        *(["ids"] if keep_ids else []),
    )


def _followed(moves: DataFrame, step: DataFrame) -> DataFrame:
    """Moves of the first bins through one more round."""
    after = step.select(F.col("bin").alias("at"), F.col("next_bin").alias("to"), F.col("next_place").alias("by"))
    both = moves.join(after, F.col("next_bin") == F.col("at"), "left")
    return both.select("bin", F.coalesce("to", "next_bin").alias("next_bin"), (F.col("next_place") + F.coalesce("by", F.lit(0))).alias("next_place"))
