"""Unigram encoding and decoding of a SentencePiece vocabulary.

The pieces sit in a double-array trie over their UTF-8 bytes. All places of a batch walk the trie together, one byte
per step; then the best segmentation of every unit is found by Viterbi, units side by side. A unit is a run of
spaces with the word behind it: no piece goes across the end of a word, so units can be encoded apart, and each
distinct unit of a batch once. Spaces are written as U+2581 and a text begins with an extra one; a
character without a piece becomes its bytes. A U+2581 of the text itself also becomes bytes, so decoding gives back
every text exactly.

A vocabulary whose scores are merge ranks (byte-pair models) gets log scores by Zipf's law: -log(rank + 1), less the
logarithm of their sum. Nothing is trained.

Defined results: a null or empty text has no ids, and decodes to the empty text. Ties between segmentations go
to the longer last piece. Very long texts are encoded whole; so are very long words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
_UNITS = re.compile(f"{MARK}| +[^ \n{MARK}]*|[^ \n{MARK}]+|\n")
KEPT_UNITS = 500_000
BYTE_PENALTY = 10.0


@dataclass
class DoubleArray:
    """Trie whose node s has the child for byte c at base[s] + c, if check there is s."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray


def double_array(keys: list[bytes], values: list[int]) -> DoubleArray:
    """Build the trie of sorted distinct keys, depth by depth; each node takes the first place that holds its children."""
    size = 1 << 16
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    check[0] = 0
    free_from = many_from = 257  # every code fits below
    queue = [(0, 0, len(keys), 0)]
    for node, lo, hi, depth in queue:
        if lo < hi and len(keys[lo]) == depth:
            value[node] = values[lo]
            lo += 1
        children, at = [], lo
        while at < hi:
            c, begin = keys[at][depth], at
            while at < hi and keys[at][depth] == c:
                at += 1
            children.append((c, begin, at))
        if not children:
            continue
        codes = np.array([c for c, _, _ in children])
        # Nodes of one child fill the gaps; the others go on where the last one was put.
        begin = max((free_from if len(codes) == 1 else many_from) - int(codes[0]), 1)
        while True:
            while begin + 4096 + 512 > size:
                base, check, value = np.append(base, np.zeros(size, np.int32)), np.append(check, np.full(size, -1, np.int32)), np.append(value, np.full(size, -1, np.int32))
                size *= 2
            free = (check[np.arange(begin, begin + (16 if len(codes) == 1 else 256))[:, None] + codes] < 0).all(1)
            if free.any():
                place = begin + int(free.argmax())
                break
            begin += len(free)
        base[node] = place
        if len(codes) > 1:
            many_from = place + int(codes[0])
        for c, first, last in children:
            check[place + c] = node
            queue.append((place + c, first, last, depth + 1))
        while check[free_from] >= 0:
            free_from += 1
    return DoubleArray(base, check, value)


@dataclass
class Vocabulary:
    """Pieces with log scores, their trie, and the ids of single bytes."""

    pieces: list[bytes]
    scores: np.ndarray
    trie: DoubleArray
    byte_ids: np.ndarray
    longest: int
    worst: float
    texts: list[bytes]


def vocabulary(model_file: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    byte_ids = np.full(256, -1, np.int32)
    normal = []
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            normal.append((piece.encode(), i, model.get_score(i)))
    return make_vocabulary(n, normal, byte_ids)


def make_vocabulary(n: int, normal: list[tuple[bytes, int, float]], byte_ids: np.ndarray) -> Vocabulary:
    """From (piece, id, score) and the ids of single bytes."""
    scores = np.full(n, -np.inf)
    ids = np.array([i for _, i, _ in normal])
    given = np.array([s for _, _, s in normal])
    if len(given) and given.min() < -1000:  # merge ranks
        ranks = np.empty(len(given))
        ranks[np.lexsort((ids, -given))] = np.arange(1, len(given) + 1)
        given = -np.log(ranks) - np.log((1.0 / np.arange(1, len(given) + 1)).sum())
    scores[ids] = given
    pieces = [b""] * n
    for piece, i, _ in normal:
        pieces[i] = piece
    ordered = sorted((piece, i) for piece, i, _ in normal)
    trie = double_array([p for p, _ in ordered], [i for _, i in ordered])
    texts = [p.replace(MARK.encode(), b" ") for p in pieces]
    for byte, i in enumerate(byte_ids.tolist()):
        texts[i] = bytes([byte])
    return Vocabulary(pieces, scores, trie, byte_ids, max(map(len, pieces), default=0), float(given.min()) if len(given) else 0.0, texts)


def _matches(raw: np.ndarray, ends: np.ndarray, words: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, id) of every piece that occurs within a unit; ``ends`` has the end of the unit of each byte."""
    starts = np.flatnonzero((raw & 0xC0) != 0x80)
    state = np.zeros(len(starts), np.int64)
    found, here = [], starts
    trie = words.trie
    for step in range(words.longest):
        inside = here + step < ends[here]
        here, state = here[inside], state[inside]
        if not len(here):
            break
        to = trie.base[state] + raw[here + step]
        alive = (trie.check[to] == state) & (trie.base[state] > 0)
        here, state = here[alive], to[alive].astype(np.int64)
        ids = trie.value[state]
        whole = ids >= 0
        found.append((here[whole], here[whole] + step + 1, ids[whole]))
    start, end, ids = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    # Characters that are no piece themselves can always be spelled as bytes.
    char_end = np.append(starts[1:], len(raw))
    single = np.zeros(len(raw) + 1, bool)
    next_char = np.zeros(len(raw) + 1, np.int64)
    next_char[starts] = char_end
    single[start[end == next_char[start]]] = True
    spelled = ~single[starts]
    return np.append(start, starts[spelled]), np.append(end, char_end[spelled]), np.append(ids, np.full(spelled.sum(), -1)).astype(np.int64)


def _piece_order(start: np.ndarray, end: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Order by ``far``, then end, then start; one number for each piece where it fits, as sorting by several keys takes far longer."""
    long = int((end - start).max(initial=0)) + 1
    if (int(far.max(initial=0)) + 1) * (int(end.max(initial=0)) + 1) * long >= 1 << 62:
        return np.lexsort((start, end, far))
    return np.argsort((far * (int(end.max(initial=0)) + 1) + end) * long + (long - 1 - (end - start)))


def _coded_units(units: list[str], words: Vocabulary) -> list[bytes]:
    """Ids of each unit by its best segmentation, as 32-bit numbers in a row."""
    coded = [(u.replace(" ", MARK) if u != MARK else u).encode() for u in units]
    spelled = np.array([u == MARK for u in units], bool)
    sizes = np.array([len(c) for c in coded])
    raw = np.frombuffer(b"".join(coded), np.uint8)
    unit_end = np.cumsum(sizes)
    unit_start = unit_end - sizes
    start, end, ids = _matches(raw, np.repeat(unit_end, sizes), words)
    unit = np.searchsorted(unit_end, start, "right")
    score = np.where(ids >= 0, words.scores[ids], words.worst - BYTE_PENALTY)
    # All pieces that end as far into their unit as each other are weighed together.
    order = _piece_order(start, end, end - unit_start[unit])
    start, end, ids, score, unit = start[order], end[order], ids[order], score[order], unit[order]
    far = end - unit_start[unit]
    best = np.full(len(raw) + len(units) + 1, -np.inf)
    slot = lambda place, u: place + u  # noqa: E731  places between bytes, one more than bytes in each unit
    best[slot(unit_start, np.arange(len(units)))] = 0.0
    back = np.full(len(best), -1, np.int64)
    cuts = np.flatnonzero(np.diff(far, prepend=0, append=-1))
    for a, b in zip(cuts, cuts[1:]):
        worth = best[slot(start[a:b], unit[a:b])] + score[a:b]
        to = slot(end[a:b], unit[a:b])
        first = np.flatnonzero(np.diff(to, prepend=-1))
        most = np.maximum.reduceat(worth, first)
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, b - a)))
        winners = np.flatnonzero(worth == most[group])
        winners = winners[np.diff(group[winners], prepend=-1) != 0]  # the earliest start, so the longest piece
        best[to[first]] = most
        back[to[first]] = a + winners
    # All units go back from their ends together, a piece at a time.
    at, open_units = unit_end.copy(), np.flatnonzero(~spelled & (sizes > 0))
    picked, owners, steps = [], [], []
    while len(open_units):
        k = back[at[open_units] + open_units]
        picked.append(k)
        owners.append(open_units)
        steps.append(len(k))
        at[open_units] = start[k]
        open_units = open_units[start[k] > unit_start[open_units]]
    if picked:
        owner = np.concatenate(owners)
        piece = np.concatenate(picked)[np.lexsort((np.repeat(-np.arange(len(steps)), steps), owner))]
    else:
        owner, piece = np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A piece is one id, or those of its bytes; a mark is always spelled.
    lengths = np.where(ids[piece] >= 0, 1, end[piece] - start[piece])
    flat = np.repeat(ids[piece], lengths)
    inside = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    as_bytes = np.flatnonzero(flat < 0)
    flat[as_bytes] = words.byte_ids[raw[np.repeat(start[piece], lengths)[as_bytes] + inside[as_bytes]]]
    counts = np.bincount(np.sort(owner), lengths, len(units)).astype(np.int64)
    ends = np.cumsum(counts) * 4
    coded_ids = flat.astype(np.int32).tobytes()
    out = [coded_ids[a:b] for a, b in zip((ends - counts * 4).tolist(), ends.tolist())]
    for u in np.flatnonzero(spelled).tolist():
        out[u] = words.byte_ids[np.frombuffer(coded[u], np.uint8)].astype(np.int32).tobytes()
    return out


def encode_units(units: list[str], words: Vocabulary) -> list[list[int]]:
    """Ids of each unit by its best segmentation."""
    return [np.frombuffer(ids, np.int32).tolist() for ids in _coded_units(units, words)]


class Encoder:
    """Encodes texts; keeps the last units it met."""

    def __init__(self, words: Vocabulary):
        self.words = words
        self.known: dict[str, bytes] = {}  # ids of a unit as 32-bit numbers in a row

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [_UNITS.findall(" " + t) if t else [] for t in texts]
        new = list({u for units in split for u in units if u not in self.known})
        if len(self.known) + len(new) > KEPT_UNITS:
            self.known = {}
            new = list({u for units in split for u in units})
        for a in range(0, len(new), 50_000):
            part = new[a : a + 50_000]
            self.known.update(zip(part, _coded_units(part, self.words)))
        ids_of = self.known.__getitem__
        return [np.frombuffer(b"".join(map(ids_of, units)), np.int32) for units in split]


def decode(ids: np.ndarray, words: Vocabulary) -> str:
    """Text of the ids: pieces with their marks as spaces, bytes as they are, without the extra first space."""
    return b"".join(map(words.texts.__getitem__, ids.tolist()))[1:].decode("utf-8")


@cache
def _loaded(model_file: str) -> tuple[Vocabulary, Encoder]:
    words = vocabulary(model_file)
    return words, Encoder(words)


def encoded(documents: DataFrame, model_file: str, text: str = "text", column: str = "ids") -> DataFrame:
    """Add the ids of every text; a column of that name is replaced. The file is read by each worker once."""

    def ids_of(texts: pa.Array) -> pa.Array:
        return pa.array(_loaded(model_file)[1].encode(texts.to_pylist()), pa.list_(pa.int32()))

    return documents.withColumn(column, F.arrow_udf(ids_of, "array<int>")(F.coalesce(F.col(text), F.lit(""))))


def decoded(documents: DataFrame, model_file: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """Add the text of every row's ids; null ids are an empty text."""

    def text_of(values: pa.Array) -> pa.Array:
        words = _loaded(model_file)[0]
        return pa.array([decode(np.array(v or [], np.int32), words) for v in values.to_pylist()], pa.string())

    return documents.withColumn(column, F.arrow_udf(text_of, "string")(F.col(ids)))


def round_trip(documents: DataFrame, model_file: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """For every text: number of ids, how many of them spell bytes, their checksum, and whether they decode to the text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, encoder = _loaded(model_file)
        spelled = np.zeros(len(words.pieces), bool)
        spelled[words.byte_ids] = True
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = encoder.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(i) for i in ids], pa.int64()), pa.array([int(spelled[i].sum()) for i in ids], pa.int64()),
                    pa.array([crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()), pa.array([decode(i, words) == t for i, t in zip(ids, texts)]),
                ],
                names=["doc_id", "n_tokens", "n_byte_tokens", "ids_crc32", "round_trip"],
            )

    source = documents.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return source.mapInArrow(rows, "doc_id long, n_tokens long, n_byte_tokens long, ids_crc32 long, round_trip boolean")
