"""Removal of long strings that occur more than once, by a distributed merge of front-coded suffix runs.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere else. Sorting the suffixes of every
position would move hundreds of bytes per byte, so only some suffixes are looked at, chosen by content:

1. Of every string of ``length`` bytes, the smallest hash of a k-gram among its first ``window`` places is its
   anchor. Equal strings have their anchors at the same place, and neighbouring strings mostly share one, so there is about
   one anchor per window / 2 bytes. The strings of an anchor start in one interval before it.
2. An anchor is keyed by the hash of the bytes that all its strings hold from it on. A key that occurs once
   has no repeated string. Anchors of one key whose strings agree altogether form a class; a class
   of two or more anchors is repeated as a whole, which settles copies and the inner parts of long repeats by counting.
3. Where one key has several classes, a repeat begins or ends nearby. One suffix for each class is fetched, from
   the anchor on, with the bytes before it. Tasks sort them into runs, front-code the runs and send them to the
   owners of key ranges. Owners merge the runs by a loser tree that never compares a known prefix
   again. The merged suffixes' common prefixes and those of the reversed bytes before them tell
   which strings are equal: those in one cluster of both orders.
4. A key with more classes than ``most_classes`` would be too large a group: its strings are hashed one by one and
   counted in the cluster instead, with the same result.

Strings are judged on the input, within and across documents; a match never crosses the end of a document.

Defined results: a null text counts as empty; texts shorter than ``length`` lose nothing. Rows that repeat another are
occurrences of their own, so both lose all their long strings. Very long texts are read whole, in overlapping pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.loser_tree import common_prefix, front_code, front_decoded, merged
from tickloom.llm.rolling import LETTER, SliceHashes, mixed
from tickloom.llm.skew import lookup_join
from tickloom.llm.storage import saved, with_row_key

LENGTH = 400
#: Passages of more than 50 words count as repeated; with the short words of the shortest such passage that is about this many bytes.
PASSAGE_BYTES = 250
GRAM = 32
PIECE = 1 << 23
PLACE_BITS = 24
RUN_RECORDS = 20_000
MOST_CLASSES = 50_000
FEW = 12
PACKED = 2_000


def window_of(length: int) -> int:
    """Places of a string among which its anchor is looked for; the bytes after the anchor stay long enough for a key."""
    return max(1, length * 5 // 8)


def _gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two) from every place."""
    h = LETTER[raw]
    step = 1
    while step < gram:
        h = h[:-step] * np.uint64(0xC2B2AE3D27D4EB4F + 2 * step) + h[step:]
        step *= 2
    return mixed(h)


def _sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(v) - width + 1
    padded = np.concatenate([v, np.full(-len(v) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    forward = np.minimum.accumulate(padded, 1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchors(raw: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(place, first start, last start, key, class) of the anchors of all strings of a byte array."""
    window = window_of(length)
    gram = min(GRAM, 1 << (max(1, length - window + 1).bit_length() - 1))
    parts = []
    for begin in range(0, max(0, len(raw) - length + 1), PIECE):
        piece = raw[begin : begin + PIECE + length - 1]
        # Equal hashes are told apart by place: the leftmost is the anchor, wherever the string stands.
        order = (_gram_hashes(piece, gram) >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(piece) - gram + 1, dtype=np.uint64)
        least = (_sliding_least(order, window)[: len(piece) - length + 1] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        new = np.flatnonzero(np.diff(least, prepend=-1))
        place, first, last = least[new], new, np.append(new[1:], len(least)) - 1
        hashes = SliceHashes(piece)
        key = hashes.of(place, place + length - window + 1)
        whole = hashes.of(first, last + length)
        kind = mixed(whole + key * np.uint64(3) + (place - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (last - first).astype(np.uint64))
        parts.append((place + begin, first + begin, last + begin, key, kind))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(p) for p in zip(*parts))


def anchors_within(raw: np.ndarray, spans: list[dict], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """The same for the strings inside the joined ``spans``; a string that crosses the end of one is left out."""
    parts = [anchors(raw[:0], length)]
    for a, b in _joined([(s["start"], s["end"] - 1) for s in spans]):
        place, first, last, key, kind = anchors(raw[a : b + 1], length)
        parts.append((place + a, first + a, last + a, key, kind))
    return tuple(np.concatenate(p) for p in zip(*parts))


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = [np.frombuffer(t.as_buffer(), np.uint8) for t in batch.column(2)]
            found = [anchors_within(r, s, length) for r, s in zip(raws, batch.column(3).to_pylist())] if batch.num_columns > 3 else [anchors(r, length) for r in raws]
            counts = [len(f[0]) for f in found]
            if sum(counts):
                place, first, last, key, kind = (np.concatenate(c) for c in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(np.repeat(batch.column(i).to_numpy(), counts)) for i in (0, 1)),
                        pa.array(key.view(np.int64)), pa.array(kind.view(np.int64)), pa.array(place), pa.array((place - first).astype(np.int32)), pa.array((place - last).astype(np.int32)),
                    ],
                    names=["k1", "k2", "key", "kind", "place", "most", "least"],
                )

    return run


_ANCHOR_SQL = "k1 long, k2 long, key long, kind long, place long, most int, least int"


# One record of a run: the suffix is the key and the bytes from the anchor on; ``before`` are the bytes in front of the anchor.
_RUN_SQL = "owner long, shared binary, rests binary, lengths binary, kinds binary, most binary, least binary, before binary"


def _records(batch: pa.RecordBatch, length: int) -> Iterator[tuple[bytes, int, int, int, bytes]]:
    for text, reps in zip(batch.column(0), batch.column(1).to_pylist()):
        raw = text.as_buffer().to_pybytes()
        for r in reps:
            p = r["place"]
            suffix = ((r["key"] & (1 << 64) - 1)).to_bytes(8, "big") + raw[p : p - r["least"] + length]
            yield suffix, r["kind"], r["most"], r["least"], raw[p - r["most"] : p]


def _suffix_runs(length: int, owner_bits: int):
    def coded(records: list) -> pa.RecordBatch:
        records.sort(key=lambda r: (r[0], r[1]))
        by_owner: dict[int, list] = {}
        for r in records:
            by_owner.setdefault(int.from_bytes(r[0][:8], "big") >> (64 - owner_bits), []).append(r)
        rows = []
        for owner, part in by_owner.items():
            suffixes, kinds, most, least, before = zip(*part)
            shared, rests, lengths = front_code(suffixes)
            rows.append(
                (owner, shared.tobytes(), rests, lengths.tobytes(), np.array(kinds, "<i8").tobytes(), np.array(most, "<u4").tobytes(), np.array(least, "<u4").tobytes(), b"".join(before))
            )
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), *[pa.binary()] * 7])], names=_RUN_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            for record in _records(batch, length):
                held.append(record)
                if len(held) >= RUN_RECORDS:
                    yield coded(held)
                    held = []
        if held:
            yield coded(held)

    return run


_RUN_NAMES = [part.split()[0] for part in _RUN_SQL.split(", ")]


def _joined(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of closed intervals of whole numbers, touching ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def equal_strings(shared: list[int], before: list[bytes], most: np.ndarray, least: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """For suffixes of one key in sorted order: distances before the anchor at which a string of ``length`` bytes starts that another one also holds.

    ``shared`` has the prefix that each suffix shares with the one before it, counted from the anchor. The strings at
    distance d are equal if the suffixes share length - d bytes and the d bytes before the anchors agree.
    """
    n = len(before)
    if n <= FEW:
        found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        backwards = [b[::-1] for b in before]
        for i in range(n):
            right = length
            for j in range(i + 1, n):
                right = min(right, shared[j])
                low = max(length - right, int(least[i]), int(least[j]), 0)
                high = min(int(most[i]), int(most[j]))
                if low <= high:
                    high = min(high, common_prefix(backwards[i], backwards[j]))
                    if low <= high:
                        found[i].append((low, high))
                        found[j].append((low, high))
        return [_joined(f) for f in found]
    # Many suffixes: clusters of both orders, distance by distance.
    right = np.array(shared)
    right[0] = 0
    order = sorted(range(n), key=lambda i: before[i][::-1])
    left = np.zeros(n, np.int64)
    for k in range(1, n):
        left[k] = common_prefix(before[order[k - 1]][::-1], before[order[k]][::-1])
    hits = np.zeros((n, int(most.max()) + 1), bool)
    for d in range(hits.shape[1]):
        use = np.flatnonzero((least <= d) & (most >= d))
        if len(use) < 2:
            continue
        of_left = np.empty(n, np.int64)
        of_left[order] = np.cumsum(left < d)
        pair = np.cumsum(right < length - d)[use] * (n + 1) + of_left[use]
        _, where, count = np.unique(pair, return_inverse=True, return_counts=True)
        hits[use, d] = count[where] > 1
    edges = np.diff(np.pad(hits.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    return [list(zip(np.flatnonzero(e == 1).tolist(), (np.flatnonzero(e == -1) - 1).tolist())) for e in edges]


_FOUND = pa.schema([("key", pa.int64()), ("kind", pa.int64()), ("near", pa.int32()), ("far", pa.int32())])
_FOUND_SQL = "key long, kind long, near int, far int"


def _merge_runs(length: int):
    """Merge the runs of one owner and report equal strings, key by key."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        columns = {c: table[c].to_pylist() for c in _RUN_NAMES[1:]}
        number = {c: [np.frombuffer(x, t) for x in columns[c]] for c, t in (("shared", "<u4"), ("lengths", "<u4"), ("kinds", "<i8"), ("most", "<u4"), ("least", "<u4"))}
        runs = [front_decoded(s, r, n) for s, r, n in zip(number["shared"], columns["rests"], number["lengths"])]
        at = [0] * len(runs)
        before_at = [0] * len(runs)
        out: list[tuple[int, int, int, int]] = []
        group: list[tuple[int, bytes, int, int, int]] = []
        current = b""

        def report() -> None:
            if len(group) > 1:
                shared, before, kinds, most, least = zip(*group)
                signed = int.from_bytes(current, "big", signed=True)
                for kind, intervals in zip(kinds, equal_strings(list(shared), list(before), np.array(most), np.array(least), length)):
                    out.extend((signed, kind, a, b) for a, b in intervals)

        for shared, suffix, r in merged(runs):
            k = at[r]
            at[r] += 1
            most = int(number["most"][r][k])
            before = columns["before"][r][before_at[r] : before_at[r] + most]
            before_at[r] += most
            if suffix[:8] != current:
                report()
                group, current = [], suffix[:8]
            group.append((max(0, shared - 8), before, int(number["kinds"][r][k]), most, int(number["least"][r][k])))
        report()
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, _FOUND.types)], schema=_FOUND)

    return run


def _string_rows(length: int):
    """Every string of the given suffixes, hashed: for keys with too many classes for one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for suffix, kind, most, least, before in _records(batch, length):
                raw = np.frombuffer(before + suffix[8:], np.uint8)
                starts = np.arange(most - least + 1)
                h = SliceHashes(raw).of(starts, starts + length).view(np.int64)
                n = len(h)
                key = int.from_bytes(suffix[:8], "big", signed=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, key)), pa.array(np.full(n, kind)), pa.array((most - starts).astype(np.int32)), pa.array(h)], names=["key", "kind", "distance", "string"])

    return run


_SPANS_SQL = "k1 long, k2 long, spans array<struct<start: long, end: long>>"


def _spans_of_packs(length: int):
    """Joined byte ranges of the members of repeated classes, one row for each document of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, place, most, least = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.column(0).flatten().flatten())
            if not len(k1):
                continue
            start, end = place - most, place - least + length
            order = np.lexsort((start, k2, k1))
            k1, k2, start, end = k1[order], k2[order], start[order], end[order]
            first = np.flatnonzero((np.diff(k1, prepend=k1[0]) != 0) | (np.diff(k2, prepend=k2[0]) != 0))
            document = np.zeros(len(k1), np.int64)
            document[first] = 1
            document = np.cumsum(document)
            # Ends reached so far within the document; a range that starts behind them begins a new one.
            far = int(end.max()) + 1
            reached = np.maximum.accumulate(end + document * far) - document * far
            new = np.append(True, (np.diff(document) != 0) | (start[1:] > reached[:-1]))
            begins = np.flatnonzero(new)
            last = np.append(begins[1:], len(k1)) - 1
            of = np.flatnonzero(np.append(True, np.diff(document[begins]) != 0))
            spans = pa.StructArray.from_arrays([pa.array(start[begins]), pa.array(reached[last])], ["start", "end"])
            offsets = pa.array(np.append(of, len(begins)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(k1[begins[of]]), pa.array(k2[begins[of]]), pa.ListArray.from_arrays(offsets, spans)], names=["k1", "k2", "spans"])

    return run


def repeated_spans(
    documents: DataFrame, length: int = LENGTH, text: str = "text", key: str = "doc_id", owner_bits: int = 8, most_classes: int = MOST_CLASSES, shorter: DataFrame | None = None
) -> DataFrame:
    """(k1, k2, spans): byte ranges to remove, which may overlap, for each document that loses any.

    ``shorter`` is the result for a smaller length. All parts of a repeated string are repeated, so it lies within the
    joined ranges found there, and only these are looked at.
    """
    texts = with_row_key(documents.select(key, text), key, text).select("k1", "k2", F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    if shorter is not None:
        texts = saved(texts.where(F.octet_length("raw") >= length).join(shorter, ["k1", "k2"]), "repeated-texts")
    found = saved(texts.where(F.octet_length("raw") >= length).mapInArrow(_anchor_rows(length), _ANCHOR_SQL), "anchors")
    keys = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("kind").alias("a"), F.max("kind").alias("b")).where("n > 1")
    keys = saved(keys.select("key", "n", (F.col("a") != F.col("b")).alias("varied")), "keys")
    members = lookup_join(found, keys.drop("n"), "key", counted=keys.select("key", F.col("n").alias("_rows")))
    # A common passage is one class with very many members; they travel in packs, so no task and no join holds all of them.
    chunks = max(1, found.count() // PACKED)
    place = F.struct("k1", "k2", "place", "most", "least")
    packed = members.groupBy("key", "kind", F.pmod(F.xxhash64("k1", "k2"), F.lit(chunks)).alias("chunk")).agg(F.collect_list(place).alias("members"), F.first("varied").alias("varied"))
    packed = saved(packed, "members")
    kinds = packed.groupBy("key", "kind").agg(F.sum(F.size("members")).alias("n"), F.first("varied").alias("varied"), F.min(F.array_min("members")).alias("rep"))
    kinds = saved(kinds, "kinds")

    varied = kinds.where("varied")
    many = saved(varied.groupBy("key").agg(F.count(F.lit(1)).alias("classes")).where(F.col("classes") > most_classes).select("key"), "large-keys")

    def fetched(part: DataFrame) -> DataFrame:
        reps = part.select("rep.k1", "rep.k2", F.struct("key", "kind", F.col("rep.place").alias("place"), F.col("rep.most").alias("most"), F.col("rep.least").alias("least")).alias("r"))
        return texts.join(saved(reps.groupBy("k1", "k2").agg(F.collect_list("r").alias("reps")), "representatives"), ["k1", "k2"]).select("raw", "reps")

    few = varied.join(many, "key", "left_anti")
    near = saved(fetched(few).mapInArrow(_suffix_runs(length, owner_bits), _RUN_SQL).groupBy("owner").applyInArrow(_merge_runs(length), _FOUND_SQL), "equal-strings")
    if not many.isEmpty():
        strings = saved(fetched(varied.join(many, "key", "left_semi")).mapInArrow(_string_rows(length), "key long, kind long, distance int, string long").distinct(), "strings")
        twice = strings.groupBy("key", "distance", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        near = near.unionByName(strings.join(twice, ["key", "distance", "string"]).select("key", "kind", F.col("distance").alias("near"), F.col("distance").alias("far")))

    # Packs of one chunk hold the same documents, so each task brings them together without a row per member.
    whole = packed.join(kinds.where("n > 1").select("key", "kind"), ["key", "kind"]).select("chunk", "members")
    whole = whole.repartition("chunk").sortWithinPartitions("chunk").select("members").mapInArrow(_spans_of_packs(length), _SPANS_SQL)
    single = kinds.where("n = 1").select("key", "kind", "rep").join(near, ["key", "kind"])
    single = single.select("rep.k1", "rep.k2", (F.col("rep.place") - F.col("far")).alias("start"), (F.col("rep.place") - F.col("near") + length).alias("end"))
    single = single.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return whole.unionByName(single).groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch], left: str | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        more = {}
        if "passages" in batch.schema.names:
            found = [_joined([(s["start"], s["end"] - 1) for s in spans or []]) for spans in batch.column("passages").to_pylist()]
            more = {"n_passages": pa.array([len(f) for f in found], pa.int64()), "n_passage_bytes": pa.array([sum(b - a + 1 for a, b in f) for f in found], pa.int64())}
            batch = batch.drop_columns(["passages"])
        for text, spans in zip(batch.column(0), batch.column(1).to_pylist()):
            raw = text.as_buffer().to_pybytes()
            gone = _joined([(s["start"], s["end"] - 1) for s in spans or []])
            kept, at = [], 0
            for a, b in gone:
                kept.append(raw[at:a])
                at = b + 1
            kept = b"".join([*kept, raw[at:]])
            what = kept.decode("utf-8", "ignore") if left == "text" else kept if left == "bytes" else None
            rows.append((len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), what))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string() if left == "text" else pa.binary()]
        cut = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)]
        yield pa.RecordBatch.from_arrays([*batch.columns[2:], *cut, *more.values()], names=[*batch.schema.names[2:], "n_bytes", "n_removed", "n_spans", "kept_sha256", "left", *more])


def without_repeats(documents: DataFrame, length: int = LENGTH, text: str = "text", key: str = "doc_id", left: str | None = "text", passages: int | None = None, **options) -> DataFrame:
    """Each document's other columns as ``others``, its sizes, the digest of the bytes left, and in ``left`` what is left.

    ``left`` is "bytes", "text" (a character that a cut has split is dropped) or None. With ``passages``, at most ``length``,
    the repeated strings of that many bytes are reported as well, and not removed: ``n_passages`` maximal runs of ``n_passage_bytes`` in all.
    """
    if not passages:
        spans = saved(repeated_spans(documents, length, text, key, **options), "spans")
    else:
        if passages > length:
            raise ValueError(f"passages of {passages} bytes are longer than the {length} bytes to remove")
        reported = saved(repeated_spans(documents, passages, text, key, **options), "passages")
        spans = saved(repeated_spans(documents, length, text, key, **options, shorter=reported), "spans")
        spans = reported.withColumnRenamed("spans", "passages").join(spans, ["k1", "k2"], "left")
    others = F.struct(*[c for c in documents.columns if c != text])
    own = with_row_key(documents.select(others.alias("others"), F.col(key).alias("own_id"), F.col(text).alias("own_text")), "own_id", "own_text")
    joined = own.join(spans, ["k1", "k2"], "left").select(F.coalesce("own_text", F.lit("")).cast("binary").alias("raw"), "spans", "others", *(["passages"] if passages else []))
    schema = f"others {joined.schema['others'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, left {'string' if left == 'text' else 'binary'}"
    if passages:
        schema += ", n_passages long, n_passage_bytes long"
    cut = joined.mapInArrow(lambda batches: _cut(batches, left), schema)
    return cut if left else cut.drop("left")
