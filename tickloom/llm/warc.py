"""Web archives: WARC records with revisits, and an index merged from sorted runs.

Writing: payload digests are counted first, so that of equal payloads one record, that of the
largest page id, is the response and the others are revisits of it. Every task writes archives of a few
megabytes, one gzip member per record, as rows of a table in the shared folder, which any executor can
read (``archive`` is a whole .warc.gz file).

Reading: every archive is parsed, its payloads are digested again, and its captures become a run sorted by URL
key and time. Runs are cut at the borders of key ranges, front-coded and sent to the range's owner, which
merges them with a loser tree. The ranges in order are the whole capture history.

Defined results: a null payload or URL counts as empty. Rows that repeat the largest page id of a payload are all
responses. A null page id is smaller than any other; if a payload has null ids only, its records are
responses. Without a time column, captures are one second apart by page id, from 2000 on. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.loser_tree import front_code, front_decoded, merged
from tickloom.llm.storage import saved

ARCHIVE_BYTES = 4_000_000
SAMPLED_KEYS = 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str) -> str:
    """Sort-friendly form: host parts reversed, then port, path and query, in lower case; the fragment is left out."""
    try:
        parts = urlsplit(url.strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower()
    host = ",".join(reversed(host.removeprefix("www.").split(".")))
    return f"{host}{f':{port}' if port else ''}){parts.path or '/'}{f'?{parts.query}' if parts.query else ''}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id: int | None, number: str, url: str, date: str, payload: bytes, digest: str, of: int | None, revisit: bool) -> bytes:
    """One record as a gzip member. The HTTP header of a revisit names the length of the payload it stands for."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:capture:{number}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url, safe='%/:?#[]@!$&()*+,;=~-._')}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-ID: {'' if page_id is None else page_id}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        head[-2:-2] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{of}>"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 4, mtime=0)


_ARCHIVE = pa.schema([("name", pa.string()), ("archive", pa.binary()), ("records", pa.int64()), ("keys", pa.list_(pa.binary()))])
_ARCHIVE_SQL = "name string, archive binary, records long, keys array<binary>"


def _sort_key(url: str, date: str, page_id: int | None) -> bytes:
    return f"{url_key(url)}\0{date}\0".encode("utf-8", "surrogatepass") + struct.pack(">Q", 0 if page_id is None else page_id + (1 << 63))


def _write(archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        out, keys, records = io.BytesIO(), [], 0

        def flush() -> pa.RecordBatch:
            nonlocal out, keys, records, number
            keys.sort(key=lambda k: (zlib.crc32(k), k))
            row = pa.record_batch([pa.array([f"part-{task:06d}-{number:06d}.warc.gz"]), pa.array([out.getvalue()], pa.binary()), pa.array([records]), pa.array([keys[:SAMPLED_KEYS]], pa.list_(pa.binary()))], schema=_ARCHIVE)
            out, keys, records, number = io.BytesIO(), [], 0, number + 1
            return row

        for batch in batches:
            for row in batch.to_pylist():
                payload = row["payload"] or b""
                revisit = row["of"] is not None and row["of"] != row["page_id"]
                out.write(_record(row["page_id"], f"{task}-{number}-{records}", row["url"], row["date"], payload, payload_digest(payload), row["of"], revisit))
                keys.append(_sort_key(row["url"], row["date"], row["page_id"]))
                records += 1
                if out.tell() >= archive_bytes:
                    yield flush()
        if records:
            yield flush()

    return run


def write_archives(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", at: str | None = None, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """The archives, as a table in the shared folder. Payloads shorter than ``least_bytes`` are never revisits."""
    page_id = F.col(key).cast("long")
    when = F.col(at).cast("timestamp") if at else F.timestamp_seconds(F.lit(946_684_800) + F.coalesce(page_id, F.lit(0)))
    captures = pages.select(
        page_id.alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), F.date_format(F.to_utc_timestamp(when, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    )
    digest = F.sha1("payload")
    shared = captures.where(F.octet_length("payload") >= least_bytes).groupBy(digest.alias("digest")).agg(F.max("page_id").alias("of"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = saved(shared.select("digest", "of"), "shared-payloads")
    long_enough = F.octet_length("payload") >= least_bytes
    named = captures.join(shared, (digest == F.col("digest")) & long_enough, "left").select("page_id", "url", "date", "payload", "of")
    return saved(named.mapInArrow(_write(archive_bytes), _ARCHIVE_SQL), "archives")


def read_records(archive: bytes) -> Iterator[dict]:
    """Records of a .warc.gz file; a payload that doesn't fit its digest is an error."""
    data = memoryview(archive)
    while data:
        member = zlib.decompressobj(31)
        raw = member.decompress(data) + member.flush()
        data = data[len(data) - len(member.unused_data) :]
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        block = rest[: int(fields["Content-Length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(http.rpartition(b"Content-Length: ")[2])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = fields["WARC-Type"] == "revisit"
        if not revisit and (len(payload) != length or payload_digest(payload) != digest):
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        yield {
            "page_id": int(fields["X-Page-ID"]) if fields["X-Page-ID"] else None, "url": fields["WARC-Target-URI"], "date": fields["WARC-Date"], "payload": payload, "payload_bytes": length,
            "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": int(fields["WARC-Refers-To"][len("<urn:page:") : -1]) if revisit else None,
        }


_RUN_SQL = "range long, run string, shared binary, rests binary, lengths binary, entries binary"
_ENTRY = ">qq?20sq?"  # page id, payload bytes, is revisit, digest, refers to, has page id


def _index_runs(borders: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, archive in zip(batch.column(0).to_pylist(), batch.column(1)):
                entries = sorted(
                    (_sort_key(r["url"], r["date"], r["page_id"]), struct.pack(_ENTRY, r["page_id"] or 0, r["payload_bytes"], r["record_type"] == "revisit", base64.b32decode(r["payload_digest"]), r["refers_to"] or 0, r["page_id"] is not None))
                    for r in read_records(archive.as_buffer())
                )
                cut: dict[int, list] = {}
                for entry in entries:
                    cut.setdefault(bisect_right(borders, entry[0]), []).append(entry)
                rows = []
                for k, part in cut.items():
                    shared, rests, lengths = front_code(key for key, _ in part)
                    rows.append({"range": k, "run": name, "shared": shared.tobytes(), "rests": rests, "lengths": lengths.tobytes(), "entries": b"".join(e for _, e in part)})
                yield pa.RecordBatch.from_pylist(rows, schema=_RUN)

    return run


_RUN = pa.schema([("range", pa.int64()), ("run", pa.string()), ("shared", pa.binary()), ("rests", pa.binary()), ("lengths", pa.binary()), ("entries", pa.binary())])


def _merge_range(pdf: pd.DataFrame) -> pd.DataFrame:
    """Captures of one key range, in order."""
    pdf = pdf.sort_values("run", kind="stable")
    runs = [front_decoded(np.frombuffer(s, "<u4"), r, np.frombuffer(n, "<u4")) for s, r, n in zip(pdf["shared"], pdf["rests"], pdf["lengths"])]
    entries = [iter(struct.iter_unpack(_ENTRY, e)) for e in pdf["entries"]]
    base = int(pdf["range"].iloc[0]) << 40
    rows = []
    for order, (_, key, run) in enumerate(merged(runs)):
        page_id, size, revisit, digest, of, known = next(entries[run])
        surt, date = key[:-8].decode("utf-8", "surrogatepass").split("\0")[:2]
        rows.append((page_id if known else None, size, base64.b32encode(digest).decode(), "revisit" if revisit else "response", of if revisit else None, surt, date, base + order))
    out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at", "index_order"])
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def capture_history(archives: DataFrame, captures_per_range: int = 200_000) -> DataFrame:
    """All captures of the archives; ``index_order`` ascends by URL key and time.

    The borders of the ranges come from a bounded sample of keys, sixteen per range at most on average, and
    affect only how evenly the work is spread: a URL with very many captures is split by time.
    """
    total = archives.agg(F.sum("records")).first()[0] or 0
    ranges = max(archives.sparkSession.sparkContext.defaultParallelism, -(-total // captures_per_range))
    sample = archives.select(F.explode("keys").alias("k")).orderBy(F.xxhash64("k"), "k").limit(16 * ranges)
    keys = sorted(bytes(r[0]) for r in sample.collect())
    borders = sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []
    runs = archives.select("name", "archive").mapInArrow(_index_runs(borders), _RUN_SQL)
    return runs.groupBy("range").applyInPandas(
        _merge_range, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string, captured_at string, index_order long"
    )
