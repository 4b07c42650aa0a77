import random
from pathlib import Path
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from helpers import TEXTS, documents, empty

from tickloom.llm import license_texts, unigram
from tickloom.llm.license_scan import TEMPLATES, license_scan, needed_words

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def best_by_hand(unit, words):
    """Plain dynamic program over the whole string, ties to the longest last piece."""
    raw = unit.encode()
    starts = [i for i in range(len(raw)) if raw[i] & 0xC0 != 0x80] + [len(raw)]
    ids = {p: i for i, p in enumerate(words.pieces) if p}
    best, back = {0: 0.0}, {}
    for end in starts[1:]:
        options = []
        for start in starts[: starts.index(end)]:
            piece = raw[start:end]
            if piece in ids:
                options.append((best[start] + words.scores[ids[piece]], -start, [ids[piece]]))
            elif starts[starts.index(start) + 1] == end:
                options.append((best[start] + words.worst - unigram.BYTE_PENALTY, -start, [int(words.byte_ids[b]) for b in piece]))
        score, start, tokens = max(options, key=lambda o: o[:2])
        best[end], back[end] = score, (-start, tokens)
    out, at = [], len(raw)
    while at:
        at, tokens = back[at]
        out = tokens + out
    return out


def small_vocabulary():
    pieces = ["a", "b", "ab", "ba", "aab", "\u2581", "\u2581a", "\u2581\u2581", "\u00e9"]
    scores = [-2.0, -2.5, -3.0, -3.5, -4.0, -2.0, -2.2, -3.0, -4.0]
    return unigram.make_vocabulary(256 + len(pieces), [(p.encode(), 256 + i, s) for i, (p, s) in enumerate(zip(pieces, scores))], np.arange(256))


def test_trie_finds_every_piece_and_nothing_else():
    words = unigram.vocabulary(MODEL)
    trie = words.trie
    for i in range(0, len(words.pieces), 37):
        node = 0
        for c in words.pieces[i]:
            to = trie.base[node] + c
            assert trie.check[to] == node and trie.base[node] > 0
            node = to
        assert not words.pieces[i] or trie.value[node] == i


@pytest.mark.parametrize("make", [small_vocabulary, lambda: unigram.vocabulary(MODEL)])
def test_viterbi_against_plain_program(make):
    words = make()
    rng = random.Random(4)
    units = ["".join(rng.choice(["a", "b", "\u00e9", "z", "th", "ing", "\U0001f600"]) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    units += [" " + u for u in units[:30]] + ["   " + u for u in units[:10]] + ["a" * 700]
    got = unigram.encode_units(units, words)
    assert got == [best_by_hand(u.replace(" ", "\u2581"), words) for u in units]


def test_round_trip_and_odd_rows(spark):
    got = {(r.doc_id, r.n_tokens): r for r in unigram.round_trip(documents(spark), MODEL).collect()}
    assert len([1 for r in got.values()]) and all(r.round_trip for r in got.values())
    assert got[(4, 0)].ids_crc32 == crc32(b"")
    again = unigram.decoded(unigram.encoded(documents(spark), MODEL), MODEL).collect()
    assert len(again) == len(TEXTS) and all(r.decoded == (r.text or "") for r in again)
    assert unigram.round_trip(empty(spark), MODEL).count() == 0


FILES = [
    ("/a/LICENSE", "Released under the MIT License."), ("/a/b/x.py", "code"), ("/a/b/y.py", "First line.\nLicensed under the Apache License, Version 2.0.\nMore lines."), ("/a/b/c/NOTICE", "Licensed under CC BY-NC 4.0"),
    ("/a/b/c/d/z", None), ("/q/r", "no license is named here, only the word"), ("top", "text"), (None, "This work is licensed under the GNU General Public License, version 3."), ("/a/b/x.py", "the same path again"),
    ("/long", "word " * 50_000 + "\nReleased under the MIT License."), ("/ab/x", "not below /a"), ("/empty", ""),
]


def test_own_and_inherited_licenses(spark):
    files = spark.createDataFrame([(*f, "clash", 1.0) for f in FILES], "path string, text string, license string, score double")
    got = {r.path: (r.license, r.source) for r in license_scan(files).collect()}
    assert got == {
        "/a/LICENSE": ("MIT", "own"), "/a/b/x.py": ("MIT", "inherited"), "/a/b/y.py": ("Apache-2.0", "own"), "/a/b/c/NOTICE": ("CC-BY-NC-4.0", "own"), "/a/b/c/d/z": ("CC-BY-NC-4.0", "inherited"),
        "/q/r": (None, "none"), "top": (None, "none"), "": ("GPL-3.0", "own"), "/long": ("MIT", "own"), "/ab/x": (None, "none"), "/empty": (None, "none"),
    }
    assert license_scan(files.limit(0)).count() == 0


def test_every_template_finds_itself(spark):
    files = spark.createDataFrame([(f"/{name}/x", f"Some text.\n{text}\nmore") for name, text in TEMPLATES], "path string, text string")
    got = license_scan(files).collect()
    assert all(r.path == f"/{r.license}/x" and r.score > 0.9 for r in got) and len(got) == len(TEMPLATES)


def test_words_left_out_can_not_match_alone():
    weights = {"the": 1.0, "of": 1.0, "licence": 5.0, "free": 2.0}
    needed = needed_words(weights, 0.7)
    light = sum(w * w for k, w in weights.items() if k not in needed)
    assert "licence" in needed and light < 0.49 * sum(w * w for w in weights.values())


def test_plan_is_native(spark):
    files = spark.createDataFrame(FILES, "path string, text string")
    plan = license_scan(files)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


BSD_CLAUSE = (
    "Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the following conditions", "are met:"
)
GPL_HEADER = (
    "Copyright (C) 2011 A. Person", "", "This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by", "the Free Software Foundation, either version 3 of the License, or",
    "(at your option) any later version.", "", "This program is distributed in the hope that it will be useful,", "but WITHOUT ANY WARRANTY; without even the implied warranty of", "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the",
    "GNU General Public License for more details.", "", "You should have received a copy of the GNU General Public License", "along with this program.  If not, see <http://www.gnu.org/licenses/>.",
)


def test_wrapped_headers_and_licence_files(spark):
    """Headers in comments of several languages and whole files, none of which has a notice on one line."""
    whole = {f.stem: f.read_text() for f in Path(license_texts.__file__).parent.glob("*.txt")}
    code = "\nimport os\n\n\ndef run(a, b):\n    return os.path.join(a, b)\n" * 30
    texts = {
        "/1/clause.py": ("BSD-3-Clause", "#!/usr/bin/env python\n# " + "\n# ".join(BSD_CLAUSE) + "\n" + code),
        "/2/two.c": ("BSD-2-Clause", "/*\n * Copyright (c) 2009, A. Person\n *\n * " + whole["BSD-2-Clause"].replace("\n", "\n * ") + "\n */\n" + code),
        "/3/gpl.py": ("GPL-3.0", "# " + "\n# ".join(GPL_HEADER) + "\n" + code),
        "/4/gpl.js": ("GPL-3.0", "/*\n" + "\n".join(GPL_HEADER) + "\n*/\n" + code),
        "/5/gpl2.cc": ("GPL-2.0", "#ifndef A_H\n#define A_H\n// " + "\n// ".join(GPL_HEADER).replace("version 3", "version 2") + "\n#include <a>\n" + code),
        "/6/LICENSE": ("MIT", "Copyright (c) 2015 A. Person and others\n\n" + whole["MIT"].split("\n\n", 1)[1]),
        "/7/plain.py": (None, "# tools for paths\n" + code),
    }
    texts |= {f"/whole/{name}/COPYING": (name, f"Copyright 2012 A. Person\n\n{text}") for name, text in whole.items()}
    files = spark.createDataFrame([(p, t) for p, (_, t) in texts.items()] + [("/6/x.py", code)], "path string, text string").repartition(4)
    got = {r.path: (r.license, r.source) for r in license_scan(files).collect()}
    assert got == {p: (name, "own" if name else "none") for p, (name, _) in texts.items()} | {"/6/x.py": ("MIT", "inherited")}


def test_header_pattern_takes_long_texts(spark):
    rows = [("/c", "# line of a comment\n" * 100_000), ("/o", "/* never closed " * 20_000), ("/p", "word\n" * 200_000), ("/b", "\n" * 300_000)]
    got = license_scan(spark.createDataFrame(rows, "path string, text string")).collect()
    assert {r.path: r.license for r in got} == dict.fromkeys(["/c", "/o", "/p", "/b"])


def test_pieces_are_ordered_alike_by_one_number_and_by_several(monkeypatch):
    rng = np.random.default_rng(5)
    start = rng.integers(0, 3_000, 5_000)
    end = start + rng.integers(1, 12, 5_000)
    start, end = np.unique(np.stack([start, end]), axis=1)
    far = end % 40
    wanted = np.lexsort((start, end, far))
    assert (unigram._piece_order(start, end, far) == wanted).all()
    assert (unigram._piece_order(start, end, far + (1 << 50)) == np.lexsort((start, end, far + (1 << 50)))).all()
    assert len(unigram._piece_order(*[np.zeros(0, np.int64)] * 3)) == 0
