"""Registered queries and pipeline stages over the small sample."""

import hashlib
import os
import re
import zlib

import compare
import corpus_pipeline
import pytest
from test_copies_packing import packed
from test_near import brute as near_brute
from test_suffix import brute as passages_brute

from tickloom.llm.registry import ORACLE, QUERIES

FOLDER = os.environ.get("TEXT_SAMPLE_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def texts(spark):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    assert compare.difference(QUERIES[name](spark, FOLDER), compare.connect(FOLDER), ORACLE[name]) is None


def test_near_query_against_all_pairs(spark, texts):
    got = QUERIES["op3_setsketch_dedup"](spark, FOLDER).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == near_brute(texts)


def test_suffix_query_against_brute_force(spark, texts):
    got = QUERIES["op6_suffix_dedup"](spark, FOLDER).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == passages_brute(texts, 400)
    whole = dict(texts)
    assert all(r.text == whole[r.doc_id] for r in got if not r.n_removed) and all(len(r.text.encode()) <= r.n_bytes - r.n_removed for r in got)


def test_edits_query(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op4_fingerprints"](spark, FOLDER).collect()}
    for (i, t), (_, u) in zip(texts, texts[1:] + texts[:1]):
        q = len(t) // 4
        assert got[i].edited_sha256 == hashlib.sha256((t[: len(t) - q] + u[:q]).encode()).hexdigest() and got[i].n_chars == len(t)
    long = [r for r in got.values() if r.n_chars > 500]
    assert sum(r.near_edited > 0.5 for r in long) > 0.97 * len(long) and sum(r.near_next < 0.3 for r in long) > 0.95 * len(long)


def test_unigram_query_round_trips(spark, texts):
    got = QUERIES["op7_unigram"](spark, FOLDER).collect()
    assert len(got) == len(texts) and all(r.round_trip for r in got)


@pytest.mark.parametrize("name,label,folds,held,least", [("op1_quality_gam", "quality", 5, 0, 0.95), ("op5_toxicity", "toxic", 3, 1, 0.75)])
def test_held_out_ranking(spark, name, label, folds, held, least):
    folder = "/root/testdata/sf0.1" if os.path.isdir("/root/testdata/sf0.1") else FOLDER
    scored = QUERIES[name](spark, folder)
    rows = scored.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in rows)
    good, bad = ([r.score for r in rows if r.held_out and r[label] == k] for k in (1, 0))
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    assert wins >= least * len(good) * len(bad) and all(0 <= r.score <= 1 for r in rows)


def test_pipeline_stages(spark, texts, tmp_path):
    """Each stage against its own definition, on what the stage before it kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        held.append(docs)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    rows = [{r.doc_id: r.text for r in d.select("doc_id", "text").collect()} for d in held[:-1]]
    rejected = {i for i, _ in texts} - set(rows[0])
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    known = [marks[i] for i in rejected if i in marks]
    assert not known or sum(known) <= 0.2 * len(known)
    best = {}
    for i, t in rows[0].items():
        best[packed(t)] = min(best.get(packed(t), (1, 0)), (-len(t), i))
    assert set(rows[1]) == {i for _, i in best.values()}
    assert set(rows[2]) == {c for _, _, c in near_brute(sorted(rows[1].items()), 0.8)}
    cut = {d: n for d, _, n, _, _ in passages_brute(sorted(rows[2].items()), corpus_pipeline.PASSAGE_BYTES)}
    assert set(rows[3]) == set(rows[2])
    assert all(len(rows[3][i].encode()) <= len(rows[2][i].encode()) - cut[i] and len(rows[2][i].encode()) - cut[i] - len(rows[3][i].encode()) <= 6 * (cut[i] > 0) + 6 for i in rows[2])
    pieces = held[4].collect()
    assert {p.doc_id for p in pieces} == set(rows[3]) and max(p.offset + p.length for p in pieces) <= 1024
    again = corpus_pipeline.run(spark, FOLDER)
    assert again.count() == len(pieces) and re.fullmatch(r".*sequence_id.*", ",".join(again.columns))
