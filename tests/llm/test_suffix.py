import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import TEXTS, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import suffix_dedup
from tickloom.llm.registry import QUERIES
from tickloom.llm.suffix_dedup import equal_strings, without_repeats


def brute(rows, length):
    seen = {}
    raws = [(t or "").encode() for _, t in rows]
    for raw in raws:
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for (d, _), raw in zip(rows, raws):
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def pieces(seed, n, alphabet, most):
    """Texts put together from shared and own passages, with edits, so that repeats begin and end anywhere."""
    rng = random.Random(seed)
    shared = ["".join(rng.choice(alphabet) for _ in range(rng.randint(10, most))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.6 else "".join(rng.choice(alphabet) for _ in range(rng.randint(1, most))) for _ in range(rng.randint(1, 5))]
        text = list("".join(parts))
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = rng.choice(alphabet)
        rows.append((i, "".join(text)))
    return rows


def got(df):
    return sorted(((r.others.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,alphabet,options", [(1, "abcdefghij é", {}), (2, "ab", {"owner_bits": 2}), (3, "abc", {"most_classes": 1})])
def test_against_brute_force(spark, seed, alphabet, options):
    rows = pieces(seed, 60, alphabet, 150)
    assert got(without_repeats(documents(spark, rows), length=40, **options)) == brute(rows, 40)


def test_production_length_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "FEW", 2)
    shared = "".join(random.Random(9).choice("abcdefgh ") for _ in range(900))
    rows = [r for r in TEXTS if len(r[1] or "") < 10_000] + [(100 + i, f"{i} start " * 9 + shared[i : 500 + 7 * i] + f" end {i}" * 9) for i in range(30)] + [(100, "0 start " * 9)]
    assert got(without_repeats(documents(spark, rows))) == brute(rows, 400)


def test_long_texts_in_pieces(spark, monkeypatch):
    assert got(without_repeats(documents(spark)))[-1] is not None
    raw = np.random.default_rng(1).integers(97, 100, 5_000).astype(np.uint8)
    whole = suffix_dedup.anchors(raw, 40)
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    parts = suffix_dedup.anchors(raw, 40)
    starts = [sorted((int(p), s) for p, a, b in zip(x[0], x[1], x[2]) for s in range(a, b + 1)) for x in (whole, parts)]
    assert starts[0] == starts[1] and len(starts[0]) == len(raw) - 39


def test_empty_table(spark):
    assert without_repeats(empty(spark)).count() == 0


@given(st.integers(0, 10_000))
@settings(deadline=None, max_examples=40)
def test_few_and_many_suffixes_agree(seed):
    rng = random.Random(seed)
    length = 12
    records = []
    for _ in range(rng.randint(2, 9)):
        most = rng.randint(0, 6)
        least = rng.randint(0, most)
        records.append(("".join(rng.choice("ab") for _ in range(length - least)).encode(), "".join(rng.choice("ab") for _ in range(most)).encode(), most, least))
    records.sort()
    shared = [0] + [suffix_dedup.common_prefix(a[0], b[0]) for a, b in zip(records, records[1:])]
    args = (shared, [r[1] for r in records], np.array([r[2] for r in records]), np.array([r[3] for r in records]), length)
    few = equal_strings(*args)
    suffix_dedup.FEW, kept = 0, suffix_dedup.FEW
    try:
        assert equal_strings(*args) == few
    finally:
        suffix_dedup.FEW = kept


def test_repeated_classes_are_not_expanded_into_rows(spark):
    shared = "".join(random.Random(4).choice("abcdefgh ") for _ in range(500))
    rows = [(i, f"{i} " * 5 + shared + f" {i}" * (i % 7)) for i in range(80)]
    spans = suffix_dedup.repeated_spans(documents(spark, rows), 40)
    # each member of a class was a row of its own before
    assert "Generate" not in spans._jdf.queryExecution().toString()
    assert spans.count() == 80
    assert got(without_repeats(documents(spark, rows), length=40)) == brute(rows, 40)


@pytest.mark.parametrize("n", [1, 2, 60, 400])
def test_spans_of_packs_are_joined_by_document(n):
    rng = random.Random(n)
    members = []
    for _ in range(n):
        place = rng.randint(0, 400)
        most = rng.randint(0, min(place, 20))
        members.append({"k1": rng.choice([-(2**63), 2**63 - 1, 5, -7]), "k2": rng.choice([-(2**63), 3]), "place": place, "most": most, "least": rng.randint(0, most)})
    kind = pa.list_(pa.struct([("k1", pa.int64()), ("k2", pa.int64()), ("place", pa.int64()), ("most", pa.int32()), ("least", pa.int32())]))
    batch = pa.RecordBatch.from_arrays([pa.array([members[: n // 2], [], members[n // 2 :]], kind)], ["members"])
    found = [r for out in suffix_dedup._spans_of_packs(10)([batch]) for r in out.to_pylist()]
    wanted = {}
    for m in members:
        wanted.setdefault((m["k1"], m["k2"]), []).append((m["place"] - m["most"], m["place"] - m["least"] + 9))
    assert len(found) == len(wanted)
    assert {(r["k1"], r["k2"]): [(s["start"], s["end"] - 1) for s in r["spans"]] for r in found} == {k: suffix_dedup._joined(v) for k, v in wanted.items()}


@pytest.mark.parametrize("seed,alphabet,options", [(5, "abcdefghij é", {}), (6, "ab", {"owner_bits": 2}), (7, "abc", {"most_classes": 1})])
def test_shorter_passages_are_reported_and_not_removed(spark, seed, alphabet, options):
    rows = pieces(seed, 60, alphabet, 150)
    rows += [*rows[:3], (None, rows[4][1]), (None, None), (70, "")]
    cut = without_repeats(documents(spark, rows), length=40, passages=25, **options)
    assert got(cut) == brute(rows, 40)
    reported = sorted(((r.others.doc_id, r.n_bytes, r.n_passage_bytes, r.n_passages) for r in cut.collect()), key=str)
    assert reported == [b[:4] for b in brute(rows, 25)]
    with pytest.raises(ValueError, match="longer"):
        without_repeats(documents(spark, rows), length=40, passages=41)


def test_query_reports_repeated_passages_of_more_than_fifty_words(spark, tmp_path):
    """Passages that two documents share and that are too short for the contract's removal."""
    rng = random.Random(8)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 7))) for _ in range(n))
    shared = [words(51) for _ in range(6)]
    assert all(250 <= len(s) < 390 for s in shared)
    rows = [(i, f"{words(80)} {shared[i % 6]} {words(70)}" if i < 12 else words(200)) for i in range(24)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in QUERIES["op6_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert sorted((tuple(r)[:5] for r in found.values()), key=str) == brute(rows, 400)
    assert all(found[i].n_passages == 1 and found[i].n_passage_bytes >= len(shared[i % 6]) for i in range(12))
    assert all(found[i].n_passages == 0 and found[i].n_passage_bytes == 0 for i in range(12, 24))


def test_anchors_within_spans_are_those_of_the_parts():
    raw = np.random.default_rng(2).integers(97, 100, 900).astype(np.uint8)
    spans = [{"start": 300, "end": 420}, {"start": 10, "end": 80}, {"start": 60, "end": 130}, {"start": 500, "end": 530}]
    place, first, last, *_ = suffix_dedup.anchors_within(raw, spans, 40)
    starts = sorted(s for a, b in zip(first, last) for s in range(a, b + 1))
    assert starts == [*range(10, 91), *range(300, 381)]
    whole = suffix_dedup.anchors(raw, 40)
    at = {s: p for p, a, b in zip(*whole[:3]) for s in range(a, b + 1)}
    assert all(at[s] == p for p, a, b in zip(place, first, last) for s in range(a, b + 1))
