"""WARC: records, and derivatives of responses as linked metadata and plain-text conversion records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches
from .markup import plain_text

VERSION = "WARC/1.1"
#: Namespace of record ids that are made from other ids, so that reruns give the same ones.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:skyshuffle:warc")
RECORD_SCHEMA = "warc_type string, record_id string, target_uri string, warc_date string, headers string, block binary"
DERIVED_SCHEMA = (
    "warc_type string, record_id string, refers_to string, refers_to_date string, target_uri string, warc_date string, content_type string, "
    "content_length long, block_digest string, source_payload_digest string, source_block_digest string, source_headers string, block string"
)
_CHUNK = re.compile(rb"[0-9A-Fa-f]+")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def made_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, json.dumps([None if p is None else str(p) for p in parts]))}>"


def serialise(headers: dict[str, str], block: bytes, compress: bool = True) -> bytes:
    """One record, as a gzip member of its own by default. Line breaks in values become spaces."""
    lines = [VERSION] + [f"{k}: {' '.join(str(v).splitlines())}" for k, v in headers.items() if k.lower() != "content-length"]
    data = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(data, mtime=0) if compress else data


_GZIP = b"\x1f\x8b\x08"
PIECE = 1 << 16  # bytes of a file that are read at once


def _stream(data: bytes) -> Iterator[bytes | None]:
    """Pieces of all gzip members in turn, or of data that is not compressed; None where a member is broken or cut off,
    after which the next member goes on."""
    view, at = memoryview(data), 0 if data[:3] == _GZIP else -1
    if at < 0:
        yield from (bytes(view[s : s + PIECE]) for s in range(0, len(data), PIECE))
    while at >= 0:
        member, end = zlib.decompressobj(31), at
        try:
            while not member.eof and end < len(data):
                piece = member.decompress(view[end : end + PIECE])
                end += len(view[end : end + PIECE])
                if piece:
                    yield piece
            if not member.eof:
                yield None
            at = data.find(_GZIP, end - len(member.unused_data))
        except zlib.error:
            yield None
            at = data.find(_GZIP, at + 1)


def _fields(head: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").splitlines():
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip()
            out[last] = f"{out[last]}, {value.strip()}" if last in out else value.strip()
    return out


def _get(fields: dict[str, str], name: str) -> str | None:
    return next((v for k, v in fields.items() if k.lower() == name.lower()), None)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, one member and one record at a time. What is cut off, and records in a broken
    gzip member, are left out; later members go on."""
    held, wanted = bytearray(), 0
    for piece in _stream(data):
        if piece is None:
            held, wanted = bytearray(), 0
            continue
        held += piece
        while len(held) >= wanted:
            start = held.find(b"WARC/")
            head = held.find(b"\r\n\r\n", start) if start >= 0 else -1
            if head < 0:
                if start < 0:
                    del held[:-4]
                wanted = len(held) + 1
                break
            fields = _fields(bytes(held[start:head]).split(b"\r\n", 1)[-1])
            length = _get(fields, "Content-Length") or "0"
            end = head + 4 + (int(length) if length.isdigit() else 0)
            if end > len(held):
                wanted = end
                break
            yield fields, bytes(held[head + 4 : end])
            del held[:end]
            wanted = 0


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.binary()]
    return pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["warc_type", "record_id", "target_uri", "warc_date", "headers", "block"])


def _row(fields: dict[str, str], block: bytes | None) -> tuple:
    return (_get(fields, "WARC-Type"), _get(fields, "WARC-Record-ID"), _get(fields, "WARC-Target-URI"), _get(fields, "WARC-Date"), json.dumps(fields), block)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files, compressed or not, one task a file, which holds the file's bytes and one record at a time.

    Headers that a record lacks are null; records cut off or in a broken gzip member are left out and later members go on;
    files that hold no records, and empty files, give no rows; repeated records each give a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block in records(content.as_py() or b""):
                    rows.append(_row(fields, block))
                    size += len(block)
                    if size > 8 << 20:
                        yield _record_batch(rows)
                        rows, size = [], 0
                yield _record_batch(rows)

    return map_batches(spark.read.format("binaryFile").load(path).select("content"), run, RECORD_SCHEMA)


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A response record for each row of pages; a null page has an empty payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                rows = []
                for pid, uri, text in zip(*(c.to_pylist() for c in batch.slice(s, 512).columns), strict=True):
                    payload = (text or "").encode()
                    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
                    fields = {
                        "WARC-Type": "response", "WARC-Record-ID": made_id("page", pid, uri), "WARC-Date": date, "Content-Type": "application/http; msgtype=response",
                        "WARC-Payload-Digest": digest(payload), "WARC-Block-Digest": digest(block), "Content-Length": str(len(block)),
                    }
                    rows.append(_row(fields | ({"WARC-Target-URI": uri} if uri is not None else {}), block))
                yield _record_batch(rows)

    return map_batches(pages.select(F.col(page_id).cast("string"), F.col(url).cast("string"), F.col(html).cast("string")), run, RECORD_SCHEMA)


def _dechunked(data: bytes) -> bytes:
    """Data of all chunks; data that does not begin with a chunk as it is; a broken chunk ends it."""
    out, at = [], 0
    while True:
        end = data.find(b"\n", at)
        size = data[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not _CHUNK.fullmatch(size):
            return b"".join(out) if out else data
        n, at = int(size, 16), end + 1
        if not n:
            return b"".join(out)
        out.append(data[at : at + n])
        at += n
        at += 2 if data[at : at + 2] == b"\r\n" else 1 if data[at : at + 1] == b"\n" else 0


def _inflated(data: bytes, bits: int) -> bytes:
    """What can be read of data's members until one is broken or cut off; nothing if that is the first byte."""
    out = []
    while data:
        member, at = zlib.decompressobj(bits), 0
        try:
            while at < len(data) and not member.eof:
                out.append(member.decompress(data[at : at + 1024]))
                at += 1024
        except zlib.error:
            break
        data = member.unused_data + data[at:]
    return b"".join(out)


def _entity(http: dict[str, str], payload: bytes) -> tuple[bytes, str | None]:
    """The payload without its transfer and content codings, and the coding that is not known, if any."""
    stated = f"{_get(http, 'Content-Encoding') or ''},{_get(http, 'Transfer-Encoding') or ''}"
    for coding in reversed([c.strip().lower() for c in stated.split(",")]):
        if coding == "chunked":
            payload = _dechunked(payload)
        elif coding in ("gzip", "x-gzip"):
            payload = _inflated(payload, 31) if payload[:2] == b"\x1f\x8b" else payload
        elif coding == "deflate":
            zlib_head = len(payload) > 1 and payload[0] & 15 == 8 and int.from_bytes(payload[:2], "big") % 31 == 0
            payload = _inflated(payload, 15 if zlib_head else -15) or payload
        elif coding not in ("", "identity"):
            return b"", coding
    return payload, None


def _derived(fields: dict[str, str], block: bytes) -> list[tuple]:
    head, _, payload = block.partition(b"\r\n\r\n") if block[:5] == b"HTTP/" else (b"", b"", block)
    status, _, rest = head.partition(b"\r\n")
    http = _fields(rest)
    source, date = _get(fields, "WARC-Record-ID"), _get(fields, "WARC-Date")
    payload_digest = _get(fields, "WARC-Payload-Digest") or digest(payload)
    block_digest = _get(fields, "WARC-Block-Digest") or digest(block)
    entity, unknown = _entity(http, payload)
    kind = _get(http, "Content-Type") or "text/html"
    charset = _CHARSET.search(kind)
    try:
        text = entity.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        text = entity.decode("utf-8", "replace")
    plain = plain_text(text) if "html" in kind.lower() else text if kind.lower().startswith("text/") else ""
    notes = [("http-status", status.decode("latin-1").partition(" ")[2])] if status else []
    notes += [(f"http-{k.lower()}", v) for k, v in http.items()]
    notes += [("source-payload-digest", payload_digest), ("source-block-digest", block_digest), ("conversion-length", str(len(plain.encode())))]
    notes += [("conversion-unknown-coding", unknown)] if unknown else []
    meta = "".join(f"{k}: {v}\r\n" for k, v in notes)
    out = []
    for warc_type, content_type, body in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", plain)):
        data = body.encode("utf-8", "replace")
        out.append((warc_type, made_id(warc_type, source, payload_digest), source, date, _get(fields, "WARC-Target-URI"), date, content_type, len(data), digest(data), payload_digest, block_digest, json.dumps(fields), body))
    return out


def derive(source: DataFrame) -> DataFrame:
    """A metadata and a conversion record for every response record; other records are left out.

    Both refer to the response by its id and date, and carry its target URI, headers and digests (computed where the
    response states none). Ids are made from the response's id and payload digest, so reruns agree. Null blocks are
    empty and empty payloads give an empty conversion; payloads that are neither HTML nor text give an empty one too;
    unknown charsets are read as UTF-8. Chunks, gzip and deflate are undone, digests are of the payload as it is stored:
    what is broken or cut off gives the part before, a payload that lacks the stated coding is taken as it is, and an
    unknown coding (br among them) gives an empty conversion and a note in the metadata record. Rows that repeat give equal records; an empty table gives no rows.
    """
    names = [part.split(" ")[0] for part in DERIVED_SCHEMA.split(", ")]
    kinds = [pa.int64() if n == "content_length" else pa.string() for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                rows = [row for headers, block in zip(part.column(0), part.column(1), strict=True) for row in _derived(json.loads(headers.as_py() or "{}"), block.as_py() or b"")]
                yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    return map_batches(source.where("lower(warc_type) = 'response'").select("headers", "block"), run, DERIVED_SCHEMA)


def serialised(derived: DataFrame, compress: bool = True) -> DataFrame:
    """The bytes of each derived record, ready to be concatenated into WARC files; its source's headers and digests too, as
    header fields. Null values give no field, a null block is empty; rows that repeat give equal records; other columns
    are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                fields = {"WARC-Type": r["warc_type"], "WARC-Record-ID": r["record_id"], "WARC-Refers-To": r["refers_to"], "WARC-Refers-To-Date": r["refers_to_date"], "WARC-Target-URI": r["target_uri"], "WARC-Refers-To-Target-URI": r["target_uri"], "WARC-Date": r["warc_date"], "Content-Type": r["content_type"], "WARC-Block-Digest": r["block_digest"], "WARC-Source-Payload-Digest": r["source_payload_digest"], "WARC-Source-Block-Digest": r["source_block_digest"], "WARC-Source-Headers": r["source_headers"]}
                out.append(serialise({k: v for k, v in fields.items() if v is not None}, (r["block"] or "").encode("utf-8", "replace"), compress))
            yield pa.record_batch([pa.array(out, pa.binary())], ["record"])

    return map_batches(derived, run, "record binary")


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(responses(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")))
