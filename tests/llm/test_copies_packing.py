import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import TEXTS, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm.golomb_dedup import drop_exact_copies, exact_groups, golomb_decode, golomb_encode
from tickloom.llm.packing import _placed, best_fit, packed_sequences


@given(st.sets(st.integers(0, 2**56 - 1), max_size=200))
@settings(deadline=None, max_examples=50)
def test_golomb_round_trip(values):
    a = np.array(sorted(values), np.uint64)
    assert (golomb_decode(golomb_encode(a, 1 << 56)) == a).all()


def packed(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def expected_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(packed(t), []).append((-len(t or ""), i is None, i))
    return sorted(
        ((i, min(g := groups[packed(t)], key=lambda x: (x[0], x[1], x[2] or 0))[2], len(g), hashlib.sha256(packed(t).encode()).hexdigest()) for i, t in rows), key=str
    )


@pytest.mark.parametrize("chunk_rows", [2, 10_000])
def test_exact_groups(spark, chunk_rows):
    got = exact_groups(documents(spark), chunk_rows=chunk_rows, owner_bits=2).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == expected_groups(TEXTS)
    kept = [r.text_sha256 for r in got if r.kept]
    assert sorted(kept) == sorted({hashlib.sha256(packed(t).encode()).hexdigest() for _, t in TEXTS})


def test_hot_group_of_copies(spark):
    rows = [(i, "same" if i % 3 else f"text {i}") for i in range(600)]
    got = exact_groups(documents(spark, rows), chunk_rows=16).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == expected_groups(rows)


def test_dropped_copies(spark):
    df = documents(spark)
    got = drop_exact_copies(df)
    assert got.columns == df.columns
    assert sorted(packed(r.text) for r in got.collect()) == sorted({packed(t) for _, t in TEXTS})


def test_empty_tables(spark):
    assert exact_groups(empty(spark)).count() == 0
    assert drop_exact_copies(empty(spark)).count() == 0
    assert packed_sequences(empty(spark), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


@given(st.lists(st.integers(1, 64), max_size=120))
@settings(deadline=None, max_examples=60)
def test_best_fit_is_gapless(sizes):
    sizes = np.array(sizes, np.int64)
    bins, offsets, fill = _placed(sizes, 64)
    assert (fill <= 64).all() and fill.sum() == sizes.sum()
    for b in range(len(fill)):
        at = sorted((o, n) for o, n, x in zip(offsets, sizes, bins) if x == b)
        assert [o for o, _ in at] == list(np.cumsum([0] + [n for _, n in at])[:-1])
    # Any two bins together hold more than one sequence, as best fit promises.
    assert len(fill) < 2 or sorted(fill)[0] + sorted(fill)[1] > 64


@pytest.mark.parametrize("most_items", [7, 50_000])
def test_packing(spark, most_items):
    rng = random.Random(5)
    rows = TEXTS + [(100 + i, " ".join(rng.choice(["alpha", "beta", "gamma", "été"]) for _ in range(rng.randint(1, 900)))) for i in range(150)]
    exact, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    got = packed_sequences(documents(spark, rows).repartition(9), exact, ranks, keep_ids=True, fan_in=2, most_items=most_items).collect()
    encoder = Tokenizer.from_file(exact)
    want = []
    for i, t in rows:
        ids = np.array([*encoder.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    whole = len(set(best_fit(np.array([r.length for r in got]), 1024)))
    # Nine partitions of twenty pieces each leave much more open than real partitions do.
    assert len(sequences) <= whole * 1.15 + 1
