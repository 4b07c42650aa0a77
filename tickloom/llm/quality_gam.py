"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a short vector of shape statistics of the whole text. Shallow trees are boosted
cyclically, one feature at a time with a small step, and each feature's trees add up to one lookup
table over its bins. Then the feature pairs that explain most of what is left get two-dimensional tables
in the same way. A score is the sigmoid of a sum of looked-up bins, computed for a whole Arrow
batch at once.

The model is fitted on the driver, on the feature vectors (not the texts) of at most ``sample_rows``
labelled rows; scoring is one narrow pass over all rows.

Defined results: a null text counts as empty; an empty text has all-zero features and gets the
score of those bins. Without any usable label every score is 0.5; with labels of one class only, scores are
the smoothed share of that class. Repeated rows are scored alike; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.labelled import label_sample, sampled_texts

FEATURES = (
    "log_bytes", "upper", "digit", "bang", "bar", "symbol", "stop", "comma", "newline", "space", "non_ascii",
    "other_mark", "log_words", "distinct_words", "next_repeats", "word_length", "longest_word", "top_word",
    "line_length", "distinct_lines", "stops_per_word", "upper_words", "starts_upper", "bytes_per_char",
)


def _byte_class() -> np.ndarray:
    table = np.zeros(256, np.intp)
    for k, chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!", b"|", b"*#$%&@^~", b".?", b",;:", b"\n", b" \t\r"), 1):
        table[list(chars)] = k
    table[128:] = 10
    rest = [c for c in range(33, 127) if not table[c] and not 97 <= c <= 122]
    table[rest] = 11
    return table


_CLASS = _byte_class()


def text_features(text: str) -> tuple[float, ...]:
    """Shape statistics of one whole text, in the order of FEATURES."""
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    if not n:
        return (0.0,) * len(FEATURES)
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = np.bincount(_CLASS, weights=by_byte, minlength=12)[1:] / n
    words = text.split()
    w = len(words)
    seen: dict[str, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    repeats = sum(map(str.__eq__, words, words[1:]))
    lines = text.split("\n")
    m = max(1, w)
    return (
        np.log1p(n), *share, np.log1p(w), len(seen) / m, repeats / m, sum(map(len, words)) / m, np.log1p(max(map(len, words), default=0)),
        max(seen.values(), default=0) / m, np.log1p(n / len(lines)), len(set(lines)) / len(lines), share[5] * n / m,
        sum(map(str.isupper, words)) / m, sum(x[0].isupper() for x in words) / m, n / len(text),
    )


def feature_matrix(texts: pd.Series) -> np.ndarray:
    return np.array([text_features(t or "") for t in texts], np.float64).reshape(-1, len(FEATURES))


@dataclass
class AdditiveModel:
    """Lookup tables of a fitted model; a few tens of kilobytes whatever it was fitted on."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        bins = self.bins(x)
        for table, b in zip(self.tables, bins):
            total += table[b]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return 1.0 / (1.0 + np.exp(-total))


def _cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram of gradients and curvatures."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _leaf(g: np.ndarray, h: np.ndarray, ridge: float) -> float:
    return float(g.sum() / (h.sum() + ridge))


def _line_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """Tree of at most three leaves over ordered bins, as one value per bin."""
    out = np.full(len(g), _leaf(g, h, ridge))
    if len(g) < 2:
        return out
    _, k = _cut(g, h, ridge)
    parts = [(0, k), (k, len(g))]
    gains = [_cut(g[a:b], h[a:b], ridge) if b - a > 1 else (-1.0, 0) for a, b in parts]
    lifts = [gain - g[a:b].sum() ** 2 / (h[a:b].sum() + ridge) if cut else -1.0 for (gain, cut), (a, b) in zip(gains, parts)]
    deep = int(np.argmax(lifts))
    if lifts[deep] > 0:
        a, b = parts[deep]
        parts[deep : deep + 1] = [(a, a + gains[deep][1]), (a + gains[deep][1], b)]
    for a, b in parts:
        out[a:b] = _leaf(g[a:b], h[a:b], ridge)
    return out


def _plane_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Tree that cuts the first feature once and each side once along the second; its gain and values."""
    best, out = -1.0, np.zeros_like(g)
    for k in range(1, g.shape[0]):
        total, sides = 0.0, []
        for rows in (slice(0, k), slice(k, None)):
            gain, cut = _cut(g[rows].sum(0), h[rows].sum(0), ridge)
            total += gain
            sides.append((rows, cut))
        if total > best:
            best = total
            for rows, cut in sides:
                out[rows, :cut] = _leaf(g[rows, :cut], h[rows, :cut], ridge)
                out[rows, cut:] = _leaf(g[rows, cut:], h[rows, cut:], ridge)
    return best, out


def fit_additive(
    x: np.ndarray, y: np.ndarray, bins: int = 32, coarse_bins: int = 8, rounds: int = 200, pairs: int = 6, pair_rounds: int = 60, step: float = 0.08, ridge: float = 5.0
) -> AdditiveModel:
    """Boost the single features in turn, then the strongest pairs on what is left."""
    model = AdditiveModel()
    if not len(y):
        return model
    prior = (y.sum() + 1.0) / (len(y) + 2.0)
    model.intercept = float(np.log(prior / (1 - prior)))
    if y.min() == y.max():
        return model
    for j in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])))
        model.tables.append(np.zeros(len(model.edges[j]) + 1))
        size = len(model.edges[j]) + 1
        model.coarse.append(np.arange(size) * min(coarse_bins, size) // size)
    binned = model.bins(x)
    total = np.full(len(y), model.intercept)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for table, b in zip(model.tables, binned):
            if len(table) > 1:
                g, h = gradients()
                tree = step * _line_tree(np.bincount(b, g, len(table)), np.bincount(b, h, len(table)), ridge)
                table += tree
                total += tree[b]
    squares = [c[b] for c, b in zip(model.coarse, binned)]
    sizes = [int(c[-1]) + 1 for c in model.coarse]

    def plane(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        g, h = gradients()
        cell = squares[i] * sizes[j] + squares[j]
        shape = (sizes[i], sizes[j])
        return cell, np.bincount(cell, g, shape[0] * shape[1]).reshape(shape), np.bincount(cell, h, shape[0] * shape[1]).reshape(shape)

    ranked = sorted((-_plane_tree(*plane(i, j)[1:], ridge)[0], i, j) for i, j in combinations(range(len(sizes)), 2) if min(sizes[i], sizes[j]) > 1)
    model.pairs = [(i, j) for _, i, j in ranked[:pairs]]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            cell, g, h = plane(i, j)
            tree = step * _plane_tree(g, h, ridge)[1]
            table += tree
            total += tree.ravel()[cell]
    return model


def fit_quality(documents: DataFrame, labels: DataFrame, learn_from: Column, label: str = "quality", key: str = "doc_id", text: str = "text", sample_rows: int = 16_000, **options) -> AdditiveModel:
    """Fit on at most ``sample_rows`` labelled rows that fulfil ``learn_from``."""
    sample = label_sample(labels, label, learn_from, sample_rows, key)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pd.DataFrame(feature_matrix(pdf["text"]), columns=list(FEATURES))
            out.insert(0, "label", pdf["label"].to_numpy())
            out.insert(0, "sample_id", pdf["sample_id"].to_numpy())
            yield out

    schema = "sample_id long, label int, " + ", ".join(f"{f} double" for f in FEATURES)
    vectors = sampled_texts(documents, sample, key, text).mapInPandas(rows, schema).toPandas()
    vectors = vectors.sort_values(list(vectors.columns), kind="stable")  # the same model whatever order rows arrive in
    return fit_additive(vectors[list(FEATURES)].to_numpy(np.float64), vectors["label"].to_numpy(np.float64), **options)


def quality_scores(documents: DataFrame, model: AdditiveModel, text: str = "text", score: str = "score") -> DataFrame:
    """Add the probability of label 1 to every row."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(feature_matrix(texts)))

    return documents.withColumn(score, scored(F.coalesce(F.col(text), F.lit(""))))
