import hashlib

import public_tokenizers  # noqa: F401
import pytest
from helpers import TEXTS, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import warc
from tickloom.llm.fingerprints import chunk_ends, compared_with_edits, fingerprint, likeness, parsed, with_fingerprint, written
from tickloom.llm.loser_tree import common_prefix, front_code, front_decoded, merged

import numpy as np


@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=30), max_size=9))
@settings(deadline=None, max_examples=80)
def test_loser_tree_merges_runs(runs):
    runs = [sorted(r) for r in runs]
    got = list(merged([front_decoded(*front_code(r)) for r in runs]))
    want = sorted((s, k) for k, r in enumerate(runs) for s in r)
    assert [(s, k) for _, s, k in got] == want
    last = b""
    for shared, s, _ in got:
        assert shared == common_prefix(last, s)
        last = s


def test_chunks_resist_shifts():
    text = np.random.default_rng(3).integers(97, 123, 20_000).astype(np.uint8).tobytes()
    ends = chunk_ends(np.frombuffer(text, np.uint8))
    sizes = np.diff([0, *ends])
    assert sizes.sum() == len(text) and sizes.max() <= 128 and 20 < sizes.mean() < 60
    a, b = fingerprint(text), fingerprint(b"some words in front" + text)
    assert likeness(a, b) > 0.99 and likeness(a, fingerprint(text[::-1])) < 0.01
    assert parsed(written(a)) == a


def brute_edits(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (i, t), (_, u) in zip(ordered, ordered[1:] + ordered[:1]):
        t, u = t or "", u or ""
        q = len(t) // 4
        e = t[: len(t) - q] + u[:q]
        f, g, h = (fingerprint(x.encode()) for x in (t, e, u))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), written(f), written(g), likeness(f, g), likeness(f, h)))
    return sorted(out, key=str)


def test_edits_against_brute_force(spark):
    rows = [(i, t) for k, (i, t) in enumerate(TEXTS) if i is not None and (i, t) not in [(9, "x")] or k == 14] + [(9_000 + 3 * i, f"document {i} " * (i % 40)) for i in range(300)]
    got = compared_with_edits(documents(spark, rows), rows_per_bucket=4).collect()
    assert sorted(map(tuple, got), key=str) == brute_edits(rows)


def test_edits_of_repeated_rows_and_few_rows(spark):
    assert compared_with_edits(documents(spark)).count() == len(TEXTS)
    assert compared_with_edits(empty(spark)).count() == 0
    one = compared_with_edits(documents(spark, [(5, "abcdefgh")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one[0].near_next == 1.0
    prints = {r.text: r.fingerprint for r in with_fingerprint(documents(spark)).collect()}
    assert prints[None] == "" and prints["x"] == written(fingerprint(b"x"))


def test_url_keys():
    assert warc.url_key("HTTP://www.Example.com:8080/A?b=1#c") == "com,example:8080)/a?b=1"
    assert warc.url_key("http://[broken") == "http://[broken" and warc.url_key("") == ")/"


PAGES = [
    (1, "http://b.example.org/x", "<p>one</p>"), (2, "http://a.example.org/", "<p>one</p>"), (3, None, None), (4, "http://a.example.org/y\nz", ""), (5, "http://c.example", "ü" * 50_000),
    (7, "http://a.example.org/", "<p>one</p>"), (8, "http://a.example.org/", "\r\n\r\nContent-Length: 5\r\n\r\n"), (7, "http://a.example.org/", "<p>one</p>"), (None, "http://d.example", "<p>one</p>"), (None, "u", "only null ids"),
]


@pytest.mark.parametrize("archive_bytes", [1, 4_000_000])
def test_archives_round_trip(spark, archive_bytes):
    pages = spark.createDataFrame([(*p, "clash", "clash") for p in PAGES], "page_id long, url string, html string, payload string, of string")
    archives = warc.write_archives(pages.repartition(3), archive_bytes=archive_bytes)
    got = warc.capture_history(archives, captures_per_range=2).orderBy("index_order").collect()
    newest = {}
    for i, _, h in PAGES:
        newest[h or ""] = max(newest.get(h or "") or -1, -1 if i is None else i)
    want = []
    for i, _, h in PAGES:
        raw = (h or "").encode()
        of = newest[h or ""]
        revisit = of != -1 and of != i
        want.append((i, len(raw), warc.payload_digest(raw), "revisit" if revisit else "response", of if revisit else None))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    assert [(r.url_key, r.captured_at) for r in got] == sorted((r.url_key, r.captured_at) for r in got)
    records = [r for a in archives.collect() for r in warc.read_records(bytes(a.archive))]
    assert sorted(r["payload"] for r in records if r["record_type"] == "response") == sorted((h or "").encode() for i, _, h in PAGES if newest[h or ""] in (-1, i))


def test_damage_is_noticed_and_empty_table(spark):
    record = warc._record(1, "0-0-0", "http://a", "2000-01-01T00:00:00Z", b"payload", warc.payload_digest(b"other"), None, False)
    with pytest.raises(ValueError):
        list(warc.read_records(record))
    none = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.capture_history(none).count() == 0
