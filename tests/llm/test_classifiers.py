import random

import numpy as np
import pytest
from helpers import TEXTS, documents, empty
from pyspark.sql import functions as F

from tickloom.llm.quality_gam import FEATURES, fit_additive, fit_quality, quality_scores, text_features
from tickloom.llm.storage import crc_fold
from tickloom.llm.toxicity import fit_compression, fit_toxicity, text_windows, toxicity_scores

FITS = [(fit_quality, quality_scores, "quality"), (fit_toxicity, toxicity_scores, "toxic")]


def labels(spark, rows):
    return spark.createDataFrame([(i, q, q, "clash") for i, q in rows], "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize("fit,score,label", FITS)
@pytest.mark.parametrize("marks", [[], [(1, 1), (6, 1)], [(1, 1), (1, 1), (6, 0), (None, 1), (9, None), (12, 0)]])
def test_scores_of_odd_rows(spark, fit, score, label, marks):
    """No labels, one class only, and repeated or null labels; every row of the table gets a score."""
    df = documents(spark)
    model = fit(df, labels(spark, marks), crc_fold("doc_id", 5) >= 0, label)
    got = score(df, model)
    assert got.columns == df.columns  # a score column of the input is replaced
    rows = got.collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text or "", r.score) == r.score
    assert score(empty(spark), model).count() == 0
    if not marks:
        assert all(r.score == 0.5 for r in rows)


def test_folds_are_those_of_crc32(spark):
    from zlib import crc32

    got = spark.range(500).select("id", crc_fold("id", 5).alias("f")).collect()
    assert all(r.f == crc32(str(r.id).encode()) % 5 for r in got)


def test_features_read_whole_texts():
    assert len(text_features("")) == len(FEATURES) == len(text_features("x" * 200_000 + " !"))
    assert text_features("a " * 50_000)[FEATURES.index("bang")] == 0 < text_features("a " * 50_000 + "!")[FEATURES.index("bang")]


def test_additive_model_learns_single_features_and_pairs():
    rng = np.random.default_rng(1)
    x = rng.random((4_000, 3))
    y = (((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)) | (x[:, 2] > 0.9)).astype(float)
    model = fit_additive(x[:3_000], y[:3_000])
    assert ((model.score(x[3_000:]) > 0.5) == y[3_000:]).mean() > 0.93
    assert (0, 1) in model.pairs
    again = fit_additive(x[:3_000], y[:3_000])
    assert (again.score(x) == model.score(x)).all()


def test_windows_hold_every_word():
    for n in range(60):
        words = [f"w{i}" for i in range(n)]
        windows = text_windows(" ".join(words))
        assert {w for x in windows for w in x.decode().split()} == set(words)
        assert bool(windows) == bool(words)


def test_compression_finds_planted_words():
    rng = random.Random(6)
    syllables = ["the", "on", "er", "ti", "an", "re", "ha", "st", "ed", "ou"]

    def text(bad):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(120)]
        for _ in range(4 if bad else 0):
            words[rng.randrange(120)] = rng.choice(["grumblefix", "zoddlewump", "quaxbit"])
        return " ".join(words)

    marks = [int(k % 3 == 0) for k in range(450)]
    texts = [text(m) for m in marks]
    model = fit_compression([(k, m, b"\n".join(text_windows(t))) for k, (m, t) in enumerate(zip(marks[:300], texts[:300]))])
    import pandas as pd

    scores = model.score(pd.Series(texts[300:]))
    assert ((scores > 0.5) == np.array(marks[300:], bool)).mean() > 0.95
    assert model.score(pd.Series([""]))[0] < 0.5


def test_learning_ignores_the_held_out_fold(spark):
    df = documents(spark, [(i, ("fine words here " * 20) if i % 2 else ("BAD!! " * 30)) for i in range(60)])
    marks = labels(spark, [(i, i % 2) for i in range(60)])
    flipped = marks.withColumn("quality", F.when(crc_fold("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (fit_quality(df, m, crc_fold("doc_id", 5) != 0) for m in (marks, flipped))
    assert all((x == y).all() for x, y in zip(a.tables, b.tables))


def test_fitting_sees_every_window_of_long_texts(spark, monkeypatch):
    from tickloom.llm import toxicity

    texts = {i: " ".join(f"w{i}x{k}" for k in range(3_000)) for i in range(4)}
    seen, trained = {}, []
    monkeypatch.setattr(toxicity, "fit_compression", lambda rows: seen.update({i: blob for i, _, blob in rows}) or toxicity.CompressionModel())
    monkeypatch.setattr(toxicity.zstandard, "train_dictionary", lambda size, samples, **_: trained.extend(samples) or toxicity.zstandard.ZstdCompressionDict(b"x" * 64))
    fit_toxicity(documents(spark, list(texts.items())), labels(spark, [(i, i % 2) for i in texts]), crc_fold("doc_id", 5) >= 0, "toxic")
    assert {i: sorted(blob.split(b"\n")) for i, blob in seen.items()} == {i: sorted(text_windows(t)) for i, t in texts.items()}
    toxicity._ordinary_dictionary([b"\n".join(b"window %08d" % k for k in range(70_000))], 1024)
    assert len(trained) == 70_000


def test_every_window_gets_the_exact_parse():
    from tickloom.llm import toxicity

    rng = random.Random(3)
    plain = [" ".join("".join(rng.choice("aeioustnr") for _ in range(5)) for _ in range(80)) for _ in range(200)]
    marked = [t + " grumblefix" * (k % 3 == 0) + " zoddlewump" * (k % 3 == 0) for k, t in enumerate(plain)]
    model = fit_compression([(k, int(k % 3 == 0), b"\n".join(text_windows(t))) for k, t in enumerate(marked)])
    windows = [w for t in plain for w in text_windows(t)] + text_windows("grum zoddle fix lewump grumble blefix zodd wump")
    calls = []
    compressors = {c: toxicity._cached(c) for c in (model.ordinary, model.ordinary + model.toxic)}

    class Counted:
        def __init__(self, content):
            self.content = content

        def compress(self, window):
            calls.append((self.content, window))
            return compressors[self.content].compress(window)

    was, toxicity._cached = toxicity._cached, Counted
    try:
        model.gains(windows)
    finally:
        toxicity._cached = was
    assert toxicity.LEVEL == 16 and sorted(calls) == sorted((c, w) for c in compressors for w in windows)


def planted_texts(n, words=120):
    rng = random.Random(8)
    syllables = ["the", "on", "er", "ti", "an", "re", "ha", "st", "ed", "ou", "é"]
    rows = []
    for k in range(n):
        text = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(words)]
        for _ in range(4 if k % 3 == 0 else 0):
            text[rng.randrange(words)] = rng.choice(["grumblefix", "zoddlewump", "quaxbit"])
        rows.append((k, " ".join(text)))
    return [*rows, (n, rows[0][1]), (n + 1, ""), (n + 2, "x")]


def test_sampled_texts_are_counted_in_tasks(spark, monkeypatch):
    """The driver sees phrases and dictionaries, no text, and the model is the one fitted on a list."""
    from tickloom.llm import toxicity

    rows = planted_texts(300)
    want = fit_compression([(i, int(i % 3 == 0), b"\n".join(text_windows(t))) for i, t in rows])
    seen, grams = [], toxicity._grams
    monkeypatch.setattr(toxicity, "_grams", lambda blob: seen.append(len(blob)) or grams(blob))
    monkeypatch.setattr(toxicity.zstandard, "train_dictionary", lambda *_, **__: pytest.fail("trained on the driver"))
    got = fit_toxicity(documents(spark, rows), labels(spark, [(i, int(i % 3 == 0)) for i, _ in rows]), crc_fold("doc_id", 5) >= 0, "toxic")
    assert (got.ordinary, got.toxic, got.noise) == (want.ordinary, want.toxic, want.noise) and b"grumbl" in got.toxic
    assert got.weights == pytest.approx(want.weights)
    assert seen and max(seen) < 100


def test_settings_are_whole_and_bounds_lose_no_gram(monkeypatch):
    import pickle
    from functools import partial

    from tickloom.llm import toxicity

    monkeypatch.setattr(toxicity, "COUNTED_BYTES", 5_000)  # several lots of texts
    rows = [(k, int(k % 3 == 0), b"\n".join(text_windows(t))) for k, t in planted_texts(60)]
    texts = toxicity.ListedTexts(rows)
    holders, contexts = [{}, {}], [{}, {}]
    for k, label, blob in texts.rows:
        for w in blob.split(b"\n"):
            for i in range(5, len(w) - 4):
                g = int.from_bytes(w[i : i + 5])
                holders[label].setdefault(g, set()).add(k)
                contexts[label].setdefault(g, set()).add(w[i - 5 : i])
    settings = [{g: min(len(holders[k][g]), len(contexts[k][g])) for g in holders[k]} for k in (0, 1)]
    n1, n0 = (sum(label == k for _, label, _ in texts.rows) for k in (1, 0))
    telling = {g for g, n in settings[1].items() if n >= 2 and toxicity._difference(n, settings[0].get(g, 0), n1, n0) >= 2}
    likely = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in texts.gathered(toxicity._bounds_found, partial(toxicity._candidates, n1=n1, n0=n0, least_z=2.0, least_docs=2))]))
    assert telling and telling <= set(likely.tolist())
    for among in (likely, np.array(sorted(settings[0].keys() | settings[1].keys()), np.uint64)):
        got = {}
        for numbers, counts in map(pickle.loads, texts.gathered(partial(toxicity._settings_found, among=among), toxicity._settings)):
            got |= {int(among[i]): tuple(c) for i, c in zip(numbers, counts.T.tolist())}
        assert got == {g: (settings[0].get(g, 0), settings[1].get(g, 0)) for g in among.tolist()}
