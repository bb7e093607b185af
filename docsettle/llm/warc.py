"""Derived records of web captures: metadata and plain-text conversions that refer to their responses.

A record is a row: its named fields in WARC order as ``headers``, and its ``block``. Both derived
records name the response in ``WARC-Refers-To``, repeat its target and its date, and carry the
digest of their own block; the metadata block keeps the response's HTTP header lines and the
digests of its payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = "record_id string, type string, refers_to string, target_uri string, block_digest string, payload_digest string, n_bytes long, headers string, block binary"

_DROPPED = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(r"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|nav|header|footer|aside|title|blockquote|pre|hr|dd|dt)\b[^>]*>", re.I)
_TAG = re.compile(r"<[!/?a-zA-Z][^>]*>")
_BLANK = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n\s*")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def plain_text(page: str) -> str:
    """All visible text of a page, a line per block; markup, scripts and styles go."""
    text = _TAG.sub("", _BREAK.sub("\n", _DROPPED.sub(" ", page)))
    text = _LINES.sub("\n", _BLANK.sub(" ", html.unescape(text)))
    return text.strip()


def record_id(*parts: str) -> str:
    """A name that a retry gives again."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(parts))}>"


def _record(kind: str, name: str, source: str, uri: str, date: str, content: str, block: bytes, payload: str) -> tuple:
    own = digest(block)
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", name),
        ("WARC-Refers-To", source),
        ("WARC-Target-URI", uri),
        ("WARC-Date", date),
        ("WARC-Block-Digest", own),
        ("Content-Type", content),
        ("Content-Length", str(len(block))),
    ]
    headers = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v)
    return name, kind, source, uri, own, payload, len(block), headers, block


def _one_line(value: str | None) -> str:
    """A header value: line ends would begin another field."""
    return re.sub(r"[\r\n]+", " ", value or "").strip()


def derive(responses: DataFrame) -> DataFrame:
    """Metadata and conversion record of every response, in that order, as rows of ``FIELDS``.

    ``responses`` has ``record_id``, ``target_uri``, ``date``, ``http_headers`` and ``payload``
    (text); other columns are not read. A null payload is an empty one: its conversion has an
    empty block. A null record id is given one made of the target and payload, so rows alike in
    both share it; null targets, dates and headers are left out. Line ends inside a value become
    blanks. Repeated rows give repeated records.
    """
    names = ["record_id", "target_uri", "date", "http_headers", "payload"]
    rows = responses.select(*(F.col(n).cast("string").alias(n) for n in names))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                out = []
                for name, uri, date, sent, page in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    page, uri, date = page or "", _one_line(uri), _one_line(date)
                    raw = page.encode()
                    of_payload = digest(raw)
                    source = _one_line(name) or record_id(uri, of_payload)
                    text = plain_text(page).encode()
                    lines = [
                        ("source-record", source),
                        ("source-payload-digest", of_payload),
                        ("source-payload-length", str(len(raw))),
                        ("conversion-digest", digest(text)),
                        *(("source-header", line) for line in (sent or "").splitlines() if line.strip()),
                    ]
                    about = "".join(f"{k}: {v}\r\n" for k, v in lines).encode()
                    out.append(_record("metadata", record_id(source, "metadata"), source, uri, date, "application/warc-fields", about, of_payload))
                    out.append(_record("conversion", record_id(source, "conversion"), source, uri, date, "text/plain; charset=utf-8", text, of_payload))
                kinds = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in FIELDS.split(", ")])

    return rows.mapInArrow(build, FIELDS)


def serialise(headers: str, block: bytes) -> bytes:
    """One record as it stands in a file: a gzip member of its own."""
    return gzip.compress(headers.encode() + b"\r\n" + block + b"\r\n\r\n", mtime=0)


def parse(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """The records of a file's bytes, compressed or not: fields and block."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    found, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        at = start + int(fields["Content-Length"]) + 4
        found.append((fields, data[start : at - 4]))
    return found


def responses_of(pages: DataFrame, date: str) -> DataFrame:
    """The response records that ``pages`` (page_id, url, html) stand for."""
    key = F.sha1(F.concat_ws(" ", F.coalesce(F.col("url"), F.lit("")), F.col("page_id").cast("string")))
    part = lambda begin, size: F.substring(key, begin, size)
    name = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">"))
    sent = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.coalesce(F.octet_length("html"), F.lit(0)).cast("string"))
    return pages.select(
        name.alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"), sent.alias("http_headers"), F.col("html").alias("payload")
    )
