"""WARC derivative builder (operator 1).

``responses`` wraps pages as WARC/1.1 response records; ``derive`` turns any
response records into two derived records each: a ``metadata`` record
(application/warc-fields: the page's links, and what was fetched) and a
``conversion`` record (text/plain: the page's visible text). Both refer to
their response by ``WARC-Refers-To``, carry over its target URI and date and
state the digests of the source beside their own. Record ids are derived from
the content, so a repeated or resumed run writes the same records.

Everything happens per record: nothing is shuffled, a lost task is run again
and gives the same bytes. ``write`` stores derived records as gzipped WARC
files, one per partition; ``read`` gives the records of plain or gzipped WARC
files back, each file streamed through one task.

Time per page is linear in its length, also where tags are never closed.
Control characters in header values are percent-encoded, so no url can start a
header line of its own.

Defined cases: a null url becomes an empty target URI, a null body an empty
payload; records that don't parse (no blank line after the HTTP header) are
taken as a bare payload; equal rows give equal records; an empty table gives
an empty result; other columns are ignored. ``read`` takes a record that is
cut off, or what is no record, as the end of its file.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Date of records whose source has none.
DATE = "1970-01-01T00:00:00Z"
_HIDDEN = re.compile(r"(?is)<!--.*?(?:(-->)|\Z)|<(script|style|noscript|template)\b[^>]*>.*?(?:(</\2\s*>)|\Z)")
_BREAK = re.compile(r"(?i)</?(?:p|div|br|h[1-6]|li|ul|ol|tr|table|article|section|nav|header|footer|title|head|body)\b[^>]*>")
_TAG = re.compile(r"<[A-Za-z/!?][^>]*>")
_LINK = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(a|link|img|iframe|form)\b([^>]*)>"
                   r"|<(script|style)\b([^>]*)>.*?(?:</\3\s*>|\Z)")
_TARGET = re.compile(r"(?is)\b(?:href|src|action)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
_SPACE = re.compile(r"[^\S\n]+")
_ANY_SPACE = re.compile(r"\s+")
_LINES = re.compile(r"\s*\n\s*")
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")

RESPONSE = "page_id long, record_id string, uri string, date string, block binary"
DERIVED = ("page_id long, refers_to string, record_type string, record_id string, uri string, date string, "
           "content_type string, n_bytes long, block_digest string, source_block_digest string, "
           "source_payload_digest string, source_status int, source_content_type string, n_links long, block binary")


def digest(data: bytes) -> str:
    """``sha1:`` and the base32 digest, as WARC writes it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: bytes | str) -> str:
    """A urn:uuid derived from the parts."""
    whole = b"\0".join(p if isinstance(p, bytes) else p.encode("utf-8", "surrogatepass") for p in parts)
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(whole).digest()[:16], version=5)}>"


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records (HTTP header and payload in ``block``) of ``page_id, url, html``."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for page, url, body in zip(b["page_id"].array, b["url"], b["html"], strict=True):
                payload = (body or "").encode("utf-8", "surrogatepass")
                block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
                         + str(len(payload)).encode() + b"\r\n\r\n" + payload)
                rows.append((page, record_id("response", url or "", date, block), url or "", date, block))
            yield pd.DataFrame(rows, columns=["page_id", "record_id", "uri", "date", "block"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInPandas(build, RESPONSE)


def parse_response(block: bytes) -> tuple[int | None, dict[str, str], bytes]:
    """Status, header fields by lower-cased name, and payload of an HTTP response."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        return None, {}, block
    first, *lines = head.decode("latin-1").split("\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    status = re.match(r"HTTP/\S+\s+(\d{3})", first)
    return int(status[1]) if status else None, fields, payload


def _decoded(payload: bytes, content_type: str) -> str:
    named = re.search(r"(?i)charset=[\"']?([\w-]+)", content_type)
    try:
        return payload.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def _closed(page: str) -> tuple[str, str]:
    """The page up to its last ``>``, and what follows: no tag ends there, so none is looked for."""
    end = page.rfind(">") + 1
    return page[:end], page[end:]


def plain_text(page: str) -> str:
    """Visible text: no markup, entities resolved, one line per block element."""
    page, tail = _closed(page)
    seen, at = [], 0
    for m in _HIDDEN.finditer(page):
        seen += [page[at:m.start()], " "]
        at = m.end()
        if not (m[1] or m[3]):  # hides all that follows
            tail = ""
    shown, comment, _ = tail.partition("<!--")
    tail = shown + (" " if comment else "")
    text, more = _closed("".join([*seen, page[at:]]))
    text, less = _closed(_BREAK.sub("\n", text))
    text = _TAG.sub("", text) + less + more + tail
    return _LINES.sub("\n", _SPACE.sub(" ", html.unescape(text))).strip()


def links(page: str) -> list[tuple[str, str]]:
    """``(element, target)`` in the page's order; what stands in comments, scripts and styles doesn't count."""
    out = []
    for m in _LINK.finditer(_closed(page)[0]):
        tag = (m[1] or m[3] or "style").lower()
        for t in _TARGET.finditer(m[2] or m[4] or "") if tag != "style" else ():
            out.append((tag, html.unescape(next(g for g in t.groups() if g is not None))))
    return out


def warc_record(row) -> bytes:
    """A derived record in WARC/1.1 form, the source's digests, status and type in fields of its own."""
    fields = [("WARC-Type", row.record_type), ("WARC-Record-ID", row.record_id), ("WARC-Date", row.date),
              ("WARC-Target-URI", row.uri), ("WARC-Refers-To", row.refers_to),
              ("WARC-Block-Digest", row.block_digest), ("WARC-Source-Block-Digest", row.source_block_digest),
              ("WARC-Source-Payload-Digest", row.source_payload_digest),
              ("WARC-Source-Status", "" if pd.isna(row.source_status) else str(int(row.source_status))),
              ("WARC-Source-Content-Type", row.source_content_type),
              ("Content-Type", row.content_type), ("Content-Length", str(len(row.block)))]
    head = "".join(f"{k}: {_CONTROL.sub(lambda m: f'%{ord(m[0]):02X}', v or '')}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogatepass") + b"\r\n" + row.block + b"\r\n\r\n"


def derive(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record of each response; columns as in ``DERIVED``."""
    names = [f.split()[0] for f in DERIVED.split(", ")]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for page_id, source, uri, date, block in zip(
                    b["page_id"].array, b["record_id"], b["uri"], b["date"], b["block"], strict=True):
                block = bytes(block or b"")
                status, fields, payload = parse_response(block)
                kind = fields.get("content-type", "")
                page = _decoded(payload, kind)
                found = links(page)
                whole, body = digest(block), digest(payload)
                meta = [("sourceStatus", "" if status is None else str(status)), ("sourceBlockDigest", whole),
                        ("sourcePayloadDigest", body), *[(f"source-{k}", v) for k, v in sorted(fields.items())],
                        *[("outlink", f"{to} {tag}") for tag, to in found]]
                clean = "".join(f"{k}: {_ANY_SPACE.sub(' ', v)}\r\n" for k, v in meta)
                for made, content, data in (
                        ("metadata", "application/warc-fields", clean.encode("utf-8", "surrogatepass")),
                        ("conversion", "text/plain; charset=utf-8", plain_text(page).encode("utf-8", "surrogatepass"))):
                    rows.append((page_id, source, made, record_id(made, source, data), uri, date, content, len(data),
                                 digest(data), whole, body, status, kind, len(found), data))
            out = pd.DataFrame(rows, columns=names)
            out["source_status"] = out["source_status"].astype("Int32")
            yield out

    return records.mapInPandas(build, DERIVED)


def write(derived: DataFrame, path: str) -> None:
    """Derived records as gzipped WARC files. Their blocks are UTF-8, so Spark's text writer holds them."""
    @F.pandas_udf("string")
    def record(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([warc_record(r).decode("utf-8", "surrogatepass").removesuffix("\r\n\r\n")
                             for r in b.itertuples()], dtype=object)

    cols = ["record_type", "record_id", "date", "uri", "refers_to", "block_digest", "source_block_digest",
            "source_payload_digest", "source_status", "source_content_type", "content_type", "block"]
    (derived.select(record.asNondeterministic()(F.struct(*cols)).alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path))


def _inflated(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a plain file or of all gzip members of one, in pieces."""
    if data[:2] != b"\x1f\x8b":
        for i in range(0, len(data), step):
            yield data[i:i + step]
        return
    at, part, member = 0, b"", zlib.decompressobj(31)
    while part or at < len(data):
        if not part:
            part = data[at:at + step]
            at += len(part)
        try:
            out = member.decompress(part, step)
            while out and not member.eof:
                yield out
                out = member.decompress(member.unconsumed_tail, step)
            yield out
        except zlib.error:
            return
        part = member.unused_data
        if member.eof:
            member = zlib.decompressobj(31)


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields by lower-cased name, and block, of the WARC records in a stream of bytes."""
    kept = bytearray()

    def upto(n: int) -> bool:
        """Reads on until ``n`` bytes are there."""
        while len(kept) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            kept.extend(piece)
        return True

    while True:
        while kept[:2] == b"\r\n" or (len(kept) < 2 and upto(2) and kept[:2] == b"\r\n"):
            del kept[:2]
        searched = 0
        while (end := kept.find(b"\r\n\r\n", searched)) < 0:
            searched = max(0, len(kept) - 3)
            if not upto(len(kept) + 1):
                return
        first, *lines = bytes(kept[:end]).decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = fields.get("content-length", "")
        if not first.startswith("WARC/") or not size.isdecimal() or not upto(end + 4 + int(size)):
            return
        yield fields, bytes(kept[end + 4:end + 4 + int(size)])
        del kept[:end + 4 + int(size)]


READ = ("record_type string, record_id string, refers_to string, uri string, date string, content_type string, "
        "block_digest string, source_block_digest string, source_payload_digest string, block binary")
_FIELDS = ["warc-type", "warc-record-id", "warc-refers-to", "warc-target-uri", "warc-date", "content-type",
           "warc-block-digest", "warc-source-block-digest", "warc-source-payload-digest"]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all WARC files under ``path``, columns as in ``READ``; fields that a record lacks are null.

    Spark reads a file (below 2 GiB, as WARC files are) into one task, which passes records on in bounded batches.
    """
    names = [f.split()[0] for f in READ.split(", ")]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data in b["content"]:
                rows, size = [], 0
                for fields, block in records(_inflated(bytes(data))):
                    rows.append((*[fields.get(f) for f in _FIELDS], block))
                    size += len(block)
                    if size > 1 << 24 or len(rows) == 1000:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("content").mapInPandas(build, READ))
