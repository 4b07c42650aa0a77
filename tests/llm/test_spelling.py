"""Spelling variants against plain versions."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import TEXTS, documents, empty

from tickloom.llm import spelling


def plain_counts(rows, least_chars=5, least_n=3):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            n[word[: h % len(word)] + word[h % len(word) + 1 :] if h % 97 == 0 else word] += 1
    return {w: k for w, k in n.items() if len(w) >= least_chars and k >= least_n}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_groups(n):
    near = defaultdict(list)
    for a, b in itertools.combinations(sorted(n), 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {a: min(v, key=lambda b: (-n[b], b)) for a, v in near.items()}
    form = {a: b for a, b in form.items() if n[b] >= 2 * n[a]}
    rows = set()
    for a in n:
        root = a
        while root in form:
            root = form[root]
        rows.add((a, form.get(a), root, n[a], len(near[a]), n[form[a]] if a in form else None))
    return rows


def test_counts_equal_a_plain_version(spark):
    rows = TEXTS + [(i, "Ünïcödé ÀÉÎõü Wörter ÿþß word-break café Łódka naïveté " * (1 + i % 3)) for i in range(400)]
    got = {r.word: r.n for r in spelling.word_counts(documents(spark, rows)).collect()}
    assert got == plain_counts(rows)


@pytest.mark.parametrize("most,sizes", [(3, (2, 5)), (20, (2, 3)), (1000, (2, 6))])
def test_groups_equal_all_pairs(spark, most, sizes):
    rng = random.Random(most)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(5, 8))) for _ in range(700)} | {"a" * k for k in range(5, 12)} | {"abab" * k for k in range(2, 5)}
    n = {w: rng.choice([3, 4, 5, 9, 20, 50, 200]) for w in words}
    table = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {tuple(r) for r in spelling.spelling_groups(table, shortest=sizes[0], longest=sizes[1], most_in_list=most).collect()}
    assert got == plain_groups(n)


def test_bound_holds_for_every_edit():
    """All but the bound's number of grams stay in the near word's decomposition, in order."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(5, 9))) for _ in range(300)]
    counts = Counter(f"\x01{w}\x01"[p : p + s] for w in words for s in range(2, 7) for p in range(len(w) + 3 - s))
    for word in words[:120]:
        grams = spelling.decomposed(word, counts, 30, 2, 6)
        bound = spelling.most_touched(grams, len(word) + 2)
        for k in range(len(word) + 1):
            for other in {word[:k] + c + word[k:] for c in "abz"} | ({word[:k] + word[k + 1 :], word[:k] + "b" + word[k + 1 :]} if k < len(word) else set()):
                kept = Counter(g for _, g in grams) & Counter(g for _, g in spelling.decomposed(other, counts, 30, 2, 6))
                assert kept.total() >= len(grams) - bound


def test_lists_find_pairs_by_themselves(spark):
    """Words with grams to spare need no other way."""
    counts = {}
    assert all(not spelling.merged_lists(w, counts, 10, 2, 6)[1] for w in ("abcde", "abcdef", "spelling"))


def test_roots_follow_long_chains(spark):
    forms = [(f"w{k:03d}", f"w{k + 1:03d}" if k < 99 else None) for k in range(100)] + [(f"x{k}", "w000") for k in range(50)]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert set(got.values()) == {"w099"} and len(got) == 150


def test_odd_rows(spark):
    assert spelling.spelling_groups(spelling.word_counts(empty(spark))).collect() == []
    assert {tuple(r) for r in spelling.spelling_groups(spelling.word_counts(documents(spark))).collect()} == plain_groups(plain_counts(TEXTS))
