"""WARC derivatives: responses to linked metadata and plain-text conversion records.

`responses` writes pages as WARC/1.1 response records. `derive` reads response records (bytes of one record, with or
without gzip) and builds for each a metadata record (application/warc-fields: the source record's headers and digests,
HTTP status, content type, character set, title, link count) and, for HTML and plain text, a conversion record
(text/plain). Both carry WARC-Refers-To with the response's WARC-Record-ID, the target URI and date of the source and
their own block digest; the metadata names the conversion record too. Record ids are UUIDs of the source id and the
record type, so a task that runs again makes the same records.

All WARC headers of the source are fields of the metadata, repeated HTTP headers each with a line of its own. Pages are
scanned tag by tag, in time that grows with their length whatever they hold; a very long page is one record. Bodies and
records that unpack to more than MOST_BYTES are errors.

A null or empty page gives a response without payload and a conversion of no text; a null URL becomes "urn:page:<id>"
(id: empty if null). A record that is no response or cannot be parsed gives one row of type "error" with the reason.
Repeated pages give equal records each time; extra columns are ignored; an empty table gives no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, text_bytes

DATE = "2024-01-01T00:00:00Z"
VERSION = b"WARC/1.1"

HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg)\b.*?(?:</\1\s*>|\Z)", re.I | re.S)
#: A tag takes all up to its end, or to the end of the page: no character is looked at for two tags.
TAG = re.compile(r"<(/?)([A-Za-z!?][A-Za-z0-9]*)[^>]*(?:>|\Z)")
BLOCKS = frozenset("p div br hr li ul ol dl dt dd h1 h2 h3 h4 h5 h6 tr table section article nav header footer main aside blockquote pre form title head body html figure figcaption option select".split())
TITLE = re.compile(r"<title\b[^<>]*>", re.I)
TITLE_END = re.compile(r"</title\s*>", re.I)
HREF = re.compile(r"\shref\s*=", re.I)
#: References to characters beyond Unicode, of any number of digits.
LONG_REFERENCE = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9A-Fa-f]{8,});?")
MOST_BYTES = 1 << 30
CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
SPACE = re.compile(r"[^\S\n]+")


def plain_text(page: str) -> str:
    """The text of an HTML page, one line per block, without scripts, styles and comments."""
    text = TAG.sub(lambda m: "\n" if m[2].lower() in BLOCKS and m[0][-1] == ">" else " ", HIDDEN.sub(" ", page))
    lines = (SPACE.sub(" ", line).strip() for line in unescaped(text).split("\n"))
    return "\n".join(line for line in lines if line)


def unescaped(text: str) -> str:
    return html.unescape(LONG_REFERENCE.sub("\ufffd", text))


def title_of(page: str) -> str:
    """The first title that is closed: without a close after the first one, none later has one."""
    begin = TITLE.search(page)
    end = TITLE_END.search(page, begin.end()) if begin else None
    return clean(unescaped(SPACE.sub(" ", page[begin.end() : end.start()]))) if end else ""


def links_of(page: str) -> int:
    return sum(1 for m in TAG.finditer(page) if m[2].lower() == "a" and not m[1] and HREF.search(m[0]))


def inflated(data: bytes, bits: int) -> bytes:
    """All gzip members (bits 31) or one zlib stream (15), MOST_BYTES at most."""
    out, size = [], 0
    while data:
        stream = zlib.decompressobj(bits)
        out.append(stream.decompress(data, MOST_BYTES - size + 1))
        size += len(out[-1])
        if size > MOST_BYTES:
            raise ValueError(f"more than {MOST_BYTES} bytes unpacked")
        if not stream.eof:
            raise EOFError("compressed data ends early")
        data = stream.unused_data.lstrip(b"\0") if bits == 31 else b""
    return b"".join(out)


class Headers(list):
    """(name in lower case, value) in their order; `get` gives the first of a name."""

    def get(self, name: str, other: str = "") -> str:
        return next((v for n, v in self if n == name), other)

    def __getitem__(self, name):
        if isinstance(name, str):
            if name not in self:
                raise KeyError(name)
            return self.get(name)
        return super().__getitem__(name)

    def __contains__(self, name) -> bool:
        return any(n == name for n, _ in self)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(chr(31).join(map(str, parts)).encode()).digest(), version=4)}>"


def clean(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value).strip()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {clean(v)}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[Headers, bytes]:
    """Headers and block of one record."""
    if data[:2] == b"\x1f\x8b":
        data = inflated(data, 31)
    head, found, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not found or not first.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = Headers()
    for line in lines:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        headers.append((name.strip().lower(), value.strip()))
    length = int(headers["content-length"])
    if length < 0:
        raise ValueError("a negative Content-Length")
    if len(rest) < length:
        raise ValueError("the block is shorter than its Content-Length")
    return headers, rest[:length]


def parse_http(block: bytes) -> tuple[str, Headers, bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    status, *lines = head.split(b"\r\n")
    return status.decode("latin-1"), Headers((n.strip().lower(), v.strip()) for n, _, v in (x.decode("latin-1").partition(":") for x in lines)), body


def decoded(http: Headers, body: bytes) -> bytes:
    """The body without chunks and compression; one that is not in the form its headers name is taken as it is."""
    if "chunked" in http.get("transfer-encoding", "").lower():
        parts, at = [], 0
        while (end := body.find(b"\r\n", at)) >= 0:
            try:
                n = int(body[at:end].split(b";")[0], 16)
            except ValueError:
                break
            if n <= 0:
                break
            parts.append(body[end + 2 : end + 2 + n])
            at = end + 2 + n + 2
        body = b"".join(parts) if parts else body
    coding = http.get("content-encoding", "").strip().lower()
    try:
        if coding in ("gzip", "x-gzip"):
            return inflated(body, 31)
        if coding == "deflate":
            return inflated(body, 15)
    except (OSError, EOFError, zlib.error):
        pass
    return body


def response(page_id: int | None, url: str | None, page: str | None, date: str = DATE) -> bytes:
    body = (page or "").encode()
    uri = clean(url) if url else f"urn:page:{'' if page_id is None else page_id}"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body
    headers = [
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", page_id, uri)), ("WARC-Target-URI", uri), ("WARC-Date", date),
        ("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response"),
    ]
    return record(headers, block)


def derivatives(data: bytes) -> list[dict]:
    """The metadata and conversion records of one response record."""
    source, block = parse(data)
    if source.get("warc-type") != "response":
        raise ValueError(f"a {source.get('warc-type')} record, not a response")
    status, http, body = parse_http(block)
    content = decoded(http, body)
    origin, uri, date = source["warc-record-id"], source.get("warc-target-uri", ""), source.get("warc-date", DATE)
    kind = http.get("content-type", "").split(";")[0].strip().lower()
    found = CHARSET.search(http.get("content-type", "")) or CHARSET.search(content[:1024].decode("latin-1"))
    charset = found[1].lower() if found else "utf-8"
    try:
        page = content.decode(charset, "replace")
    except LookupError:
        charset, page = "utf-8", content.decode("utf-8", "replace")
    has_text = kind in ("text/html", "application/xhtml+xml", "text/plain", "")
    common = [("WARC-Refers-To", origin), ("WARC-Target-URI", uri), ("WARC-Date", date)]
    conversion, meta = record_id("conversion", origin), record_id("metadata", origin)
    told = {"warc-type", "warc-record-id", "warc-block-digest", "warc-payload-digest", "content-length"}
    fields = [
        ("source-record-id", origin), ("source-block-digest", source.get("warc-block-digest", digest(block))),
        ("source-payload-digest", source.get("warc-payload-digest", digest(body))), ("computed-payload-digest", digest(body)),
        *((f"source-{k}", v) for k, v in source if k not in told),
        ("http-status", status), *((f"http-{k}", v) for k, v in sorted(http, key=lambda x: x[0])), ("charset", charset),
        ("title", title_of(page) if kind != "text/plain" else ""), ("links", str(links_of(page))),
        *([("conversion-record-id", conversion)] if has_text else []),
    ]
    notes = "".join(f"{k}: {clean(v)}\r\n" for k, v in fields).encode()
    out = [("metadata", meta, "application/warc-fields", notes)]
    if has_text:
        out.append(("conversion", conversion, "text/plain; charset=utf-8", (page if kind == "text/plain" else plain_text(page)).encode()))
    return [
        {
            "warc_type": t, "record_id": r, "refers_to": origin, "target_uri": uri, "block_digest": digest(b), "content_length": len(b),
            "record": record([("WARC-Type", t), ("WARC-Record-ID", r), *common, ("WARC-Block-Digest", digest(b)), ("Content-Type", c)], b),
            "block": b, "error": None,
        }
        for t, r, c, b in out
    ]


DERIVED = "page_id bigint, warc_type string, record_id string, refers_to string, target_uri string, block_digest string, content_length bigint, block binary, record binary, error string"


def responses(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) to page_id and the bytes of a response record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, htmls = (batch.column(k) for k in range(3))
            out = [response(i.as_py(), u.as_py(), h.as_py()) for i, u, h in zip(ids, urls, htmls, strict=True)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.binary())], names=["page_id", "record"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id bigint, record binary")


def derive(records: DataFrame) -> DataFrame:
    """Response records (page_id, record) to their metadata and conversion records, one row each."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(DERIVED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            off, data = text_bytes(batch.column(1))
            for k, page_id in enumerate(batch.column(0).to_pylist()):
                try:
                    rows = derivatives(data[off[k] : off[k + 1]].tobytes())
                except (ValueError, KeyError, OSError, EOFError, zlib.error) as e:
                    rows = [{"warc_type": "error", "error": f"{type(e).__name__}: {e}"}]
                out += [{"page_id": page_id} | r for r in rows]
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    return records.select("page_id", F.coalesce("record", F.lit("").cast("binary")).alias("record")).mapInArrow(run, DERIVED)


def members(derived: DataFrame) -> DataFrame:
    """Gzip members of the derived records; a WARC file is any number of them one after another."""

    @F.pandas_udf("binary")
    def packed(records):
        return records.map(lambda r: gzip.compress(r, mtime=0))

    return derived.where("record IS NOT NULL").select("page_id", "record_id", packed("record").alias("member"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = derive(responses(read(spark, sf_dir, "pages")))
    return derived.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "block_digest", "content_length", F.sha2("record", 256).alias("record_sha256"))
