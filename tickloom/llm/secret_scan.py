"""Secrets in texts: patterns, and strings that dictionary-primed compression finds new in a sensitive context.

1. Identifiers near sensitive words (password, token, key ...) are counted over all texts, in documents; the most frequent ones fill a zstandard dictionary,
   which so holds what the surroundings of such words usually say. Its size is a parameter, whatever the number of texts.
2. Every run of ``least_length`` key characters near a sensitive word is a candidate, unless a pattern reports it already.
3. A candidate's novelty is the compressed size of its surroundings with it, less the size without it, both primed with the dictionary. Words of the
   language and known identifiers are matched and cost little; a random key costs about all its bytes. Candidates
   that cost ``least_share`` of their bytes and mix two kinds of characters are reported as ``novel``.

Defined results: a null text counts as empty and has no secrets. Rows are judged one by one, so repeated rows and null ids stay as they
are. Texts are read whole. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.storage import saved

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")
LEAST_VALUE, LEAST_ACCESS = 6, 20

ASSIGNED_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
SENSITIVE_WORDS = (*ASSIGNED_WORDS, b"passphrase", b"pwd", b"credential", b"api-key", b"access key", b"access_key", b"private key", b"private_key", b"bearer", b"signing key", b"authorization")
SENSITIVE = re.compile("|".join(re.escape(w.decode()) for w in SENSITIVE_WORDS), re.IGNORECASE | re.ASCII)
IDENTIFIER = re.compile(r"[A-Za-z_À-ÿ][A-Za-z0-9_.À-ÿ-]{2,63}")
_FLUSH_AT = 200_000


def base_spans(text: str, lowered: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches; ``lowered`` is the text in bytes, lower-cased, to pass over texts without any."""
    found = []
    if any(word in lowered for word in ASSIGNED_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def windows(text: str, lowered: bytes, reach: int) -> list[tuple[int, int]]:
    """Merged ranges of ``reach`` code points around sensitive words."""
    if not any(word in lowered for word in SENSITIVE_WORDS):
        return []
    merged: list[tuple[int, int]] = []
    for m in SENSITIVE.finditer(text):
        start, end = max(0, m.start() - reach), min(len(text), m.end() + reach)
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], end)
        else:
            merged.append((start, end))
    return merged


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    for value in batch.column("text"):
        data = value.as_py() or b""
        yield data.decode(), data.lower()


def context_dictionary(docs: DataFrame, text_column: str = "text", reach: int = 64, size: int = 65_536, words: int = 16_384) -> bytes:
    """The most frequent identifiers near sensitive words, by the number of texts that hold them, at most ``words`` and ``size`` bytes.

    All texts are counted. The most frequent come last, where references to them cost least.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> Iterator[pa.RecordBatch]:
            if counts:
                yield pa.RecordBatch.from_arrays([pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()

        for batch in batches:
            for text, lowered in _texts(batch):
                counts.update({w for start, end in windows(text, lowered, reach) for w in IDENTIFIER.findall(text, start, end)})
                if len(counts) >= _FLUSH_AT:
                    yield from flushed()
        yield from flushed()

    counted = docs.select(F.col(text_column).cast("binary").alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = saved(counted.where("n > 1"), "identifiers").orderBy(F.desc("n"), "word").limit(words).collect()
    kept, used = [], 0
    for row in top:
        used += len(row["word"].encode()) + 1
        if used > size:
            break
        kept.append(row["word"])
    return " ".join(reversed(kept)).encode()


def _kinds_mixed(run: str) -> int:
    return any(c.islower() for c in run) + any(c.isupper() for c in run) + any(c.isdigit() for c in run)


def novelty(compressor: zstandard.ZstdCompressor, before: str, run: str, after: str) -> int:
    """Bytes that the run adds to its compressed surroundings."""
    ahead, behind = before.encode(), after.encode()
    return len(compressor.compress(ahead + run.encode() + behind)) - len(compressor.compress(ahead + behind))


def novel_spans(text: str, lowered: bytes, base: list[tuple[int, int, int]], compressor: zstandard.ZstdCompressor, reach: int, around: int, least_length: int, least_share: float) -> list[tuple[int, int, int]]:
    """(start, kind, end) of runs in sensitive contexts that no pattern reports and that compression finds new."""
    found = []
    candidate = re.compile(rf"[A-Za-z0-9+/_=-]{{{least_length},}}")
    done = 0
    for start, end in windows(text, lowered, reach):
        for m in candidate.finditer(text, max(start, done)):
            if m.start() >= end:
                break
            done = m.end()
            run = m.group()
            if _kinds_mixed(run) < 2 or any(s < m.end() and m.start() < e for s, _, e in base):
                continue
            added = novelty(compressor, text[max(0, m.start() - around) : m.start()], run, text[m.end() : m.end() + around])
            if added >= least_share * len(run):
                found.append((m.start(), 3, m.end()))
    return found


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def secret_scan(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", reach: int = 64, around: int = 256, least_length: int = 16, least_share: float = 0.75, level: int = 9,
    dictionary: bytes | None = None,
) -> DataFrame:
    """One row per text: doc_id, n_assign, n_access, n_hex, base_sha256 (of the patterns' spans) and spans (kind:start:end, novel ones included)."""
    content = context_dictionary(docs, text_column, reach) if dictionary is None else dictionary

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if content else None
        compressor = zstandard.ZstdCompressor(level=level, dict_data=primed, write_checksum=False, write_content_size=False)
        for batch in batches:
            counts, digests, spans = [], [], []
            for text, lowered in _texts(batch):
                base = base_spans(text, lowered)
                kinds = [kind for _, kind, _ in base]
                counts.append([kinds.count(k) for k in range(3)])
                digests.append(hashlib.sha256(spelled(base).encode()).hexdigest())
                spans.append(spelled(base + novel_spans(text, lowered, base, compressor, reach, around, least_length, least_share)))
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    return rows.mapInArrow(scan, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
