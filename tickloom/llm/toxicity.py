"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary text, one on the phrases that set toxic text
apart. A window of a few words is compressed twice, once primed with the ordinary dictionary and once
with the ordinary one continued by the toxic one; the bytes that the toxic continuation saves are the window's gain.
Every window is measured by zstandard's exact parse with the entropy tables of the trained dictionary, which tells
an offensive stem of five bytes from chance.
A text's gains (largest, mean of the two largest, the sum above a noise level, and the number of windows) are
turned into a probability by a logistic curve calibrated on labelled texts that the dictionaries were not trained on.

Both compressors share the ordinary dictionary because two unrelated dictionaries of a few
kilobytes differ by chance by more than one offensive word saves.

Everything is fitted on at most ``toxic_rows`` + ``ordinary_rows`` labelled texts, with all windows of
each, as scoring uses every window of every text. The sample stays in a table: tasks count its byte grams, find the
phrases and measure the windows, and one task trains the ordinary dictionary. The driver gets the few grams and phrases that
may tell toxic texts apart, two dictionaries, and the gains of the calibrating texts.

Defined results: a null text counts as empty; an empty text has no window and gains of 0. Without labels
of both classes every score is the smoothed share of label 1. Equal texts score alike.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from zlib import crc32

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.labelled import label_sample, sampled_texts
from tickloom.llm.storage import saved

WINDOW, STRIDE, GRAM, LEVEL, CORE = 6, 4, 5, 16, 0.8
SLICES, COUNTED_BYTES = 32, 2 << 20  # slices of the grams that are counted apart, and text that a task counts at once

#: Family, label and windows (joined by line feeds) of a sampled text.
Row = tuple[int, int, bytes]


def text_windows(text: str, window: int = WINDOW, stride: int = STRIDE) -> list[bytes]:
    """Overlapping windows of whole words of the lower-cased text, as UTF-8; all words are in at least one."""
    words = text.lower().split()
    return [" ".join(words[i : i + window]).encode("utf-8", "surrogatepass") for i in range(0, max(len(words) - window + stride, 1) if words else 0, stride)]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=64, dict_size=len(content), min_match=4, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    # The trained dictionary's own entropy tables are used, which make single bytes count.
    primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_AUTO)
    primed.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=primed, compression_params=params)


@dataclass
class CompressionModel:
    """Two dictionaries of a few kilobytes and a calibrated curve."""

    ordinary: bytes = b""
    toxic: bytes = b""
    noise: float = 0.0
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0, 0.0)

    def gains(self, windows: list[bytes]) -> np.ndarray:
        if not self.toxic or not windows:
            return np.zeros(0)
        plain, primed = _cached(self.ordinary), _cached(self.ordinary + self.toxic)
        return np.maximum(np.array([len(plain.compress(w)) - len(primed.compress(w)) for w in windows], np.float64), 0)

    def summary(self, gains: np.ndarray) -> tuple[float, ...]:
        """Largest gain, mean of the two largest, log of the sum above the noise, log of the number of windows."""
        if not len(gains):
            return 0.0, 0.0, 0.0, 0.0
        top = np.sort(gains)[::-1][:2]
        return float(max(top[0], 0)), float(max(top.mean(), 0)), float(np.log1p(np.clip(gains - self.noise, 0, None).sum())), float(np.log1p(len(gains)))

    def score(self, texts: pd.Series) -> np.ndarray:
        x = np.array([self.summary(self.gains(text_windows(t or ""))) for t in texts]).reshape(-1, 4)
        return 1.0 / (1.0 + np.exp(-(self.weights[0] + x @ np.array(self.weights[1:]))))


_COMPRESSORS: dict[bytes, zstandard.ZstdCompressor] = {}


def _cached(content: bytes) -> zstandard.ZstdCompressor:
    """Compressors can't be sent to a task; each worker keeps those of its last models."""
    if content not in _COMPRESSORS:
        if len(_COMPRESSORS) > 8:
            _COMPRESSORS.clear()
        _COMPRESSORS[content] = _compressor(content)
    return _COMPRESSORS[content]


def _ordinary_dictionary(docs: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on windows of ordinary texts; too few samples are their own dictionary."""
    samples = [w for d in docs for w in d.split(b"\n") if len(w) >= 8]
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=6).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def _grams(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte grams at every place of windows joined by line feeds, and which of them lie within one window."""
    a = np.frombuffer(blob, np.uint8)
    n = len(a) - GRAM + 1
    h, whole = np.zeros(max(n, 0), np.uint64), np.ones(max(n, 0), bool)
    for i in range(GRAM if n > 0 else 0):
        h = (h << np.uint64(8)) | a[i : n + i]
        whole &= a[i : n + i] != 10
    return h, whole


def _with_context(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Grams that have as many bytes before them in their window, and these bytes as a gram."""
    h, whole = _grams(blob)
    use = whole[GRAM:] & whole[:-GRAM]
    return h[GRAM:][use], h[: max(len(h) - GRAM, 0)][use]


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs; sorting is several times faster here than numpy's hashing."""
    values = np.sort(values)
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[: len(values)])
    return values[starts], np.diff(starts, append=len(values))


def _slices(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(SLICES)


def _together(rows: Iterable[Row]) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of one label, as many as are counted at once."""
    held: dict[int, list[bytes]] = {0: [], 1: []}
    for _, label, blob in rows:
        held[label].append(blob)
        if sum(map(len, held[label])) >= COUNTED_BYTES:
            yield label, held[label]
            held[label] = []
    yield from ((label, blobs) for label, blobs in held.items() if blobs)


def _bounds_found(rows: Iterable[Row]) -> Iterator[tuple[int, bytes]]:
    """For every gram of a few texts: how many of them hold it, and at least how many contexts it has there.

    Contexts are told apart by 24 bits, so their number may come out too low, never too high.
    """
    for label, blobs in _together(rows):
        grams, contexts = [], []
        for blob in blobs:
            g, before = _with_context(blob)
            contexts.append(_distinct(g << np.uint64(24) | before * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(40))[0])
            grams.append(_distinct(contexts[-1] >> np.uint64(24))[0])
        by_text, texts = _distinct(np.concatenate(grams))
        least = _distinct(_distinct(np.concatenate(contexts))[0] >> np.uint64(24))[1]
        slices = _slices(by_text)
        for k in range(SLICES):
            of = slices == k
            if of.any():
                yield k, pickle.dumps((label, by_text[of], texts[of].astype(np.uint32), least[of].astype(np.uint32)))


def _difference(count: np.ndarray, elsewhere: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """How far the shares of toxic and of ordinary texts differ, in standard deviations."""
    return (count / n1 - elsewhere / n0) / np.sqrt((count + elsewhere) / (n1 + n0) * (1 / n1 + 1 / n0))


def _candidates(found: list[bytes], n1: int, n0: int, least_z: float, least_docs: int) -> bytes:
    """Grams of a slice that may tell toxic texts apart.

    A gram has no more settings in toxic texts than texts that hold it, and no fewer in the ordinary ones than the
    lesser of texts and contexts found. The difference grows with the first and falls with the second.
    """
    parts = [pickle.loads(x) for x in found]
    grams, _ = _distinct(np.concatenate([p[1] for p in parts]))
    texts, contexts = np.zeros((2, len(grams))), np.zeros((2, len(grams)))
    for label, own, n, least in parts:
        at = np.searchsorted(grams, own)
        texts[label, at] += n
        contexts[label, at] = np.maximum(contexts[label, at], least)
    z = _difference(texts[1], np.minimum(texts[0], contexts[0]), n1, n0)
    return grams[(texts[1] >= least_docs) & (z >= least_z)].tobytes()


def _settings_found(rows: Iterable[Row], among: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Of the grams ``among``, by their number: how many texts hold each, and its distinct contexts there (24 bits for the gram, 40 for the context)."""
    for label, blobs in _together(rows):
        own, at, contexts = [], [], []
        for blob in blobs:
            g, before = _with_context(blob)
            near = np.minimum(np.searchsorted(among, g), len(among) - 1)
            use = among[near] == g
            at.append(near[use])
            contexts.append(before[use])
            own.append(_distinct(at[-1])[0])
        number, texts = _distinct(np.concatenate(own))
        at, contexts = np.concatenate(at), np.concatenate(contexts)
        slices = at % SLICES
        for k in range(SLICES):
            if len(of := np.flatnonzero(number % SLICES == k)):
                pairs = (at[slices == k] // SLICES).astype(np.uint64) << np.uint64(40) | contexts[slices == k]
                yield k, pickle.dumps((label, number[of], texts[of], _distinct(pairs)[0]))


def _settings(found: list[bytes]) -> bytes:
    """Numbers of grams and in how many settings of ordinary and of toxic texts each stands.

    A setting is a text, or the bytes before the gram, whichever are fewer. So neither a word that one
    text repeats nor a passage that many copies share counts more than once.
    """
    parts = [pickle.loads(x) for x in found]
    numbers, _ = _distinct(np.concatenate([number for _, number, _, _ in parts]))
    counts = np.zeros((2, len(numbers)), np.int64)
    for label in (0, 1):
        texts = np.zeros(len(numbers), np.int64)
        for _, number, n, _ in (p for p in parts if p[0] == label):
            texts[np.searchsorted(numbers, number)] += n
        pairs = _distinct(np.concatenate([np.zeros(0, np.uint64), *(p[3] for p in parts if p[0] == label)]))[0]
        of = np.searchsorted(numbers // SLICES, (pairs >> np.uint64(40)).astype(np.int64))
        counts[label] = np.minimum(texts, np.bincount(of, minlength=len(numbers)))
    return pickle.dumps((numbers, counts))


def _phrases_found(rows: Iterable[Row], grams: np.ndarray, z: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Runs of telling grams in toxic texts: how many texts hold each, and its strength."""
    found: dict[bytes, int] = {}
    strengths: dict[bytes, float] = {}
    for _, _, blob in rows:
        h, whole = _grams(blob)
        at = np.minimum(np.searchsorted(grams, h), len(grams) - 1)
        strength = np.where((grams[at] == h) & whole, z[at], 0.0) if len(h) else np.zeros(0)
        runs = np.flatnonzero(np.diff(np.concatenate([[0], (strength > 0).astype(np.int8), [0]]))).reshape(-1, 2)
        phrases = set()
        for a, b in runs:
            core = np.flatnonzero(strength[a:b] >= CORE * strength[a:b].max())  # without the words around it
            phrase = blob[a + core[0] : a + core[-1] + GRAM]
            phrases.add(phrase)
            strengths[phrase] = max(strengths.get(phrase, 0.0), float(strength[a:b].max()))
        for phrase in phrases:
            found[phrase] = found.get(phrase, 0) + 1
    for k in {crc32(phrase) % SLICES for phrase in found}:
        yield k, pickle.dumps([(phrase, n, strengths[phrase]) for phrase, n in found.items() if crc32(phrase) % SLICES == k])


def _phrases(found: list[bytes]) -> bytes:
    merged: dict[bytes, tuple[int, float]] = {}
    for phrase, n, strength in (x for part in found for x in pickle.loads(part)):
        was = merged.get(phrase, (0, 0.0))
        merged[phrase] = was[0] + n, max(was[1], strength)
    return pickle.dumps(merged)


def _toxic_dictionary(toxic: Texts, both: Texts, n1: int, n0: int, size: int, least_z: float, least_docs: int) -> bytes:
    """Phrases that stand in far more settings of toxic than of ordinary texts, the most telling ones last.

    Zstandard's own trainer would fill a dictionary with what is frequent in toxic texts, which is the language
    they share with the others. So grams are ranked by how far their frequency differs, their runs
    in toxic windows are the phrases, and phrases are taken greedily while they bring grams not yet covered.
    Bounds rule out nearly all grams first, so that contexts are gathered for few.
    """
    likely = both.gathered(_bounds_found, partial(_candidates, n1=n1, n0=n0, least_z=least_z, least_docs=least_docs))
    among = np.sort(np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x, np.uint64) for x in likely)]))
    if not len(among):
        return b""
    parts = [pickle.loads(x) for x in both.gathered(partial(_settings_found, among=among), _settings)]
    counts = np.zeros((2, len(among)), np.int64)
    for numbers, settings in parts:
        counts[:, numbers] = settings
    elsewhere, count = counts
    z = _difference(count, elsewhere, n1, n0)
    grams, z = among[(count >= least_docs) & (z >= least_z)], z[(count >= least_docs) & (z >= least_z)]
    if not len(grams):
        return b""
    found = {p: v for part in toxic.gathered(partial(_phrases_found, grams=grams, z=z), _phrases) for p, v in pickle.loads(part).items()}
    chosen: list[bytes] = []
    covered: set[int] = set()
    telling_grams = set(grams.tolist())
    for phrase in sorted(found, key=lambda p: (-found[p][0] * found[p][1], p)):
        own = set(_grams(phrase)[0].tolist()) & telling_grams if len(phrase) >= GRAM else set()
        if own - covered and sum(map(len, chosen)) + len(phrase) <= size:
            chosen.append(phrase)
            covered |= own
    return b"".join(reversed(chosen))


def _family(blob: bytes) -> int:
    """Smallest window hash, alike for most copies of a text."""
    return min(map(crc32, blob.split(b"\n")))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[float, ...]:
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    keep = np.eye(x.shape[1]) * ridge
    keep[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-x @ w))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


class Texts:
    """Texts to fit on, one of each family of copies; what is found in them is gathered by part and merged."""

    def sizes(self) -> list[tuple[int, int, int]]:
        """Family, label and bytes of the windows of each text."""
        raise NotImplementedError

    def labels(self) -> tuple[int, int]:
        """How many texts were sampled, copies included, and how many of them have label 1."""
        raise NotImplementedError

    def only(self, label: int | None = None, held: bool | None = None, empty: bool = False) -> Texts:
        """Those of a label, and those that calibrate (``held``) or train."""
        raise NotImplementedError

    def gathered(self, found: Callable[[Iterable[Row]], Iterator[tuple[int, bytes]]], merge: Callable[[list[bytes]], bytes]) -> list[bytes]:
        raise NotImplementedError


def _is_held(family: int) -> bool:
    """Every third family calibrates what the others trained."""
    return family % 3 == 0


class ListedTexts(Texts):
    """A few texts of this process."""

    def __init__(self, texts: Iterable[tuple[int, int, bytes]]):
        listed, families = sorted(texts), {}
        for _, label, blob in listed:
            families.setdefault(_family(blob), (label, blob))
        self.rows = [(f, *v) for f, v in families.items()]
        self.sampled = len(listed), sum(label for _, label, _ in listed)

    def sizes(self):
        return [(f, label, len(blob)) for f, label, blob in self.rows]

    def labels(self):
        return self.sampled

    def only(self, label=None, held=None, empty=False):
        part = ListedTexts([])
        part.rows = [r for r in self.rows if label in (None, r[1]) and held in (None, _is_held(r[0])) and (empty or r[2])]
        return part

    def gathered(self, found, merge):
        parts: dict[int, list[bytes]] = {}
        for k, x in found(self.rows):
            parts.setdefault(k, []).append(x)
        return [merge(parts[k]) for k in sorted(parts)]


class SampledTexts(Texts):
    """Texts of a table with ``family``, ``sample_id``, ``label``, ``windows``, and ``copies`` and ``toxic_copies`` of the family."""

    def __init__(self, table: DataFrame):
        self.table = table

    def __iter__(self) -> Iterator[tuple[int, int, bytes]]:
        for r in self.table.select("sample_id", "label", "windows").toLocalIterator():
            yield r.sample_id, r.label, bytes(r.windows)

    def sizes(self):
        return [tuple(r) for r in self.table.select("family", "label", F.octet_length("windows")).collect()]

    def labels(self):
        r = self.table.agg(F.sum("copies"), F.sum("toxic_copies")).first()
        return r[0] or 0, r[1] or 0

    def only(self, label=None, held=None, empty=False):
        table = self.table if empty else self.table.where(F.octet_length("windows") > 0)
        if label is not None:
            table = table.where(F.col("label") == label)
        return SampledTexts(table if held is None else table.where((F.col("family") % 3 == 0) == held))

    def gathered(self, found, merge):
        def rows(batches: Iterator[pd.DataFrame]) -> Iterator[Row]:
            for pdf in batches:
                yield from zip(pdf["family"].tolist(), pdf["label"].tolist(), map(bytes, pdf["windows"]))

        def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for k, x in found(rows(batches)):
                yield pd.DataFrame({"part": [k], "payload": [x]})

        def merged(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"part": pdf["part"].iloc[:1], "payload": [merge([bytes(x) for x in pdf["payload"]])]})

        schema = "part int, payload binary"
        parts = self.table.select("family", "label", "windows").mapInPandas(emit, schema).groupBy("part").applyInPandas(merged, schema)
        return [bytes(r.payload) for r in sorted(parts.collect())]


def _in_order(rows: Iterable[Row]) -> Iterator[tuple[int, bytes]]:
    for family, _, blob in rows:
        yield 0, pickle.dumps(((_is_held(family), family), blob))


def _trained(found: list[bytes], size: int) -> bytes:
    """Zstandard's trainer sees its samples together; their order counts."""
    return _ordinary_dictionary([blob for _, blob in sorted(map(pickle.loads, found))], size)


def _gains_found(rows: Iterable[Row], model: CompressionModel) -> Iterator[tuple[int, bytes]]:
    for family, label, blob in rows:
        yield family % SLICES, pickle.dumps([(family, label, model.gains(blob.split(b"\n")).astype(np.int32))])


def _joined(found: list[bytes]) -> bytes:
    return pickle.dumps([x for part in found for x in pickle.loads(part)])


def fit_compression(texts: Iterable[tuple[int, int, bytes]], ordinary_size: int = 16_384, toxic_size: int = 1024, least_effect: float = 0.33, least_docs: int = 5) -> CompressionModel:
    """Fit on (id, label, windows joined by line feeds); every third family of copies calibrates what the others trained."""
    texts = texts if isinstance(texts, Texts) else ListedTexts(texts)
    n, n_toxic = texts.labels()
    prior = (n_toxic + 1) / (n + 2)
    flat = CompressionModel(weights=(float(np.log(prior / (1 - prior))), 0.0, 0.0, 0.0, 0.0))
    if n_toxic in (0, n):
        return flat
    sizes = texts.sizes()

    def dictionaries(held: bool | None) -> tuple[bytes, bytes]:
        n0, n1 = (sum(1 for f, label, size in sizes if label == k and size and held in (None, _is_held(f))) for k in (0, 1))
        if not n0 or not n1:
            return b"", b""
        (ordinary,) = texts.only(0, held).gathered(_in_order, partial(_trained, size=ordinary_size))
        least_z, docs = max(5.0, least_effect * n1**0.5), min(least_docs, max(2, n1 // 4))
        return ordinary, _toxic_dictionary(texts.only(1, held), texts.only(None, held), n1, n0, toxic_size, least_z, docs)

    trial = CompressionModel(*dictionaries(False))
    if not trial.toxic or not any(_is_held(f) for f, _, _ in sizes):
        return flat
    found = texts.only(held=True, empty=True).gathered(partial(_gains_found, model=trial), _joined)
    measured = sorted((x for part in found for x in pickle.loads(part)), key=lambda x: x[0])
    gains, y = [g.astype(np.float64) for _, _, g in measured], np.array([label for _, label, _ in measured], np.float64)
    trial.noise = float(np.quantile(np.concatenate([g for g, label in zip(gains, y) if not label] or [np.zeros(1)]), 0.99))
    x = np.array([trial.summary(g) for g in gains]).reshape(-1, 4)
    weights = _logistic(x, y)
    ordinary, toxic = dictionaries(None)
    return CompressionModel(ordinary, toxic, trial.noise, weights)


def fit_toxicity(
    documents: DataFrame, labels: DataFrame, learn_from: Column, label: str = "toxic", key: str = "doc_id", text: str = "text",
    toxic_rows: int = 1_500, ordinary_rows: int = 3_000, **options,
) -> CompressionModel:
    """Fit on a bounded sample of each class among the labelled rows that fulfil ``learn_from``."""
    sample = label_sample(labels, label, learn_from & (F.col(label) == 1), toxic_rows, key).unionByName(label_sample(labels, label, learn_from & (F.col(label) == 0), ordinary_rows, key))
    share = labels.where(learn_from & F.col(label).isNotNull()).agg(F.avg(label).alias("share"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            windows = [b"\n".join(text_windows(t)) for t in pdf["text"]]
            yield pd.DataFrame({"family": [_family(w) for w in windows], "sample_id": pdf["sample_id"], "label": pdf["label"], "windows": windows})

    found = sampled_texts(documents, sample, key, text).mapInPandas(rows, "family long, sample_id long, label int, windows binary")
    families = found.repartition(SLICES, "family").groupBy("family").agg(F.min(F.struct("sample_id", "label", "windows")).alias("first"), F.count("*").alias("copies"), F.sum("label").alias("toxic_copies"))
    texts = SampledTexts(saved(families.select("family", "first.*", "copies", "toxic_copies"), "toxicity_sample"))
    n, n_toxic = texts.labels()
    model = fit_compression(texts, **options)
    return _rebalanced(model, n_toxic / n if n else 0.5, share.first()["share"])


def _rebalanced(model: CompressionModel, sampled: float, everywhere: float | None) -> CompressionModel:
    """Move the intercept from the sample's share of toxic rows to that of all labelled rows."""
    if everywhere and 0 < everywhere < 1 and 0 < sampled < 1:
        shift = np.log(everywhere / (1 - everywhere)) - np.log(sampled / (1 - sampled))
        model.weights = (model.weights[0] + float(shift), *model.weights[1:])
    return model


def toxicity_scores(documents: DataFrame, model: CompressionModel, text: str = "text", score: str = "score") -> DataFrame:
    """Add the probability of label 1 to every row; a column of that name is replaced."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts))

    return documents.withColumn(score, scored(F.coalesce(F.col(text), F.lit(""))))
