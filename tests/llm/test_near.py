import random

import numpy as np
from helpers import TEXTS, documents, empty

from tickloom.llm.components import components
from tickloom.llm.setsketch_dedup import likely_similarity, near_components, shingles, sketch


def brute(rows, threshold=0.85):
    import re

    def words(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [words(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                k = len(sets[i] & sets[j])
                if 100 * k >= round(100 * threshold) * (len(sets[i]) + len(sets[j]) - k):
                    parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def made(n=160):
    """Families of edited copies, chains whose ends are far apart, and texts that share a passage."""
    rng = random.Random(11)
    rows = []
    passage = [f"p{i}" for i in range(40)]
    for f in range(12):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(30, 200))]
        for c in range(n // 12):
            for _ in range(rng.randint(0, 2)):
                words = list(words)
                words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
            rows.append((1000 - len(rows), " ".join(words)))
    rows += [(2000 + i, " ".join(passage + [f"own{i}_{k}" for k in range(rng.randint(1, 30))])) for i in range(40)]
    return rows


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 501), (501, 500), (7, 7)]
    links = [p if rng.random() < 0.5 else p[::-1] for p in links]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 500: 500, 501: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_components_against_all_pairs(spark):
    rows = made() + TEXTS
    for options in ({}, {"block": 3, "small_bucket": 2}):
        got = near_components(documents(spark, rows), 0.85, **options).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


def test_empty_table(spark):
    assert near_components(empty(spark), 0.85).count() == 0


def test_estimates_are_close():
    rng = np.random.default_rng(4)
    for share in (0.0, 0.4, 0.7, 0.77):
        n, m = 900, 700
        both = int(share * (n + m) / (1 + share))
        pool = rng.integers(0, 2**63, n + m - both).astype(np.uint64)
        a, b = sketch(pool[:n]), sketch(pool[n - both :])
        j = likely_similarity(np.array([(a > b).sum()]), np.array([(a < b).sum()]), np.array([n * 1.0]), np.array([m * 1.0]))[0]
        assert abs(j - both / (n + m - both)) < 0.17
        assert (np.maximum(a, b) == sketch(pool)).all()
    assert len(shingles("A b")) == 1 and (shingles("A b") == shingles("a  B")).all() and len(shingles(" \t")) == 0


def test_pipeline_keeps_one_row_of_null_and_repeated_ids(spark):
    import corpus_pipeline

    words = [f"word{k}" for k in range(300)]
    one, copy = " ".join(words), " ".join([*words[:-1], "other"])
    two, copy_of_two = (t.replace("word", "term") for t in (one, copy))
    three, copy_of_three = (t.replace("word", "name") for t in (one, copy))
    rows = [(None, one), (None, copy), (7, two), (8, copy_of_two), (8, three), (5, copy_of_three), (9, ""), (None, " ")]
    got = corpus_pipeline.near(spark, documents(spark, rows), "").select("doc_id", "text").collect()
    named = sorted((r.doc_id, r.text) for r in got if r.doc_id is not None)
    assert named == sorted([(7, two), (5, copy_of_three), (9, "")])
    assert sorted(len(r.text) for r in got if r.doc_id is None) in ([1, len(one)], [1, len(copy)])
