"""Metadata and plain-text conversion records derived from WARC responses.

Every response gives two records. The *metadata* record holds, as JSON, the WARC
headers and the HTTP head of the response, its title and its links, made
absolute. The *conversion* record holds the plain text. Both refer to the
response by ``WARC-Refers-To``, name each other by ``WARC-Concurrent-To``, keep
its target and date, carry the response's digests as ``WARC-Source-...`` headers
and have a block digest of their own. Record ids are UUIDs derived from the
response's id and the type, so that a rerun makes the same records.

One narrow pass over the responses; nothing is exchanged. ``write_warc`` lets
Spark write the records to any file system as gzipped WARC files, one per task.

Rows, one by one: a null url is left out of the headers, a null page an empty
payload; a block without an HTTP head is all payload; bytes that are no UTF-8 (or
of the charset the head names) are replaced; blocks are read whole, and markup
that is never closed ends with the block; equal pages give equal records; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import batches, map_batches

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"

# fixed values: HTML elements without text of their own, and those that begin a line
SILENT = {"script", "style", "noscript", "template", "title"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main",
    "nav", "ol", "option", "p", "pre", "section", "table", "td", "th", "tr", "ul",
}

# a quoted value behind an equals sign may hold < and >; other quotes are plain characters
_TAG = re.compile(r"""<!--|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>=]|=\s*+(?:"[^"]*"|'[^']*')?+)*+)>|<[!?][^<>]*>""")
_HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_BLANKS = re.compile(r"[^\S\n]+")

RESPONSE = "page_id {kind}, record_id string, target_uri string, date string, block binary, block_digest string, payload_digest string"
RECORD = (
    "page_id {kind}, record_type string, record_id string, refers_to string, target_uri string, headers string, "
    "content_type string, block string, block_digest string, payload_digest string"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_urn(*parts: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, "\x00".join(parts)).urn


def http_parts(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, header fields and payload of an HTTP response."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        return "", [], block
    status, *lines = head.decode("latin-1").split("\r\n")
    fields = [line.partition(":") for line in lines]
    return status, [(name.strip(), value.strip()) for name, colon, value in fields if colon], payload


def decoded(payload: bytes, fields: list[tuple[str, str]]) -> str:
    kind = next((value for name, value in fields if name.lower() == "content-type"), "")
    named = re.search(r"charset\s*=\s*\"?([\w-]+)", kind, re.IGNORECASE)
    try:
        return payload.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def page_content(page: str, base: str) -> tuple[str, str, list[str]]:
    """Title, plain text (a line per block, without empty lines) and absolute links of a page, in one walk."""
    out: list[str] = []
    title: list[str] = []
    links: list[str] = []
    at, silent = 0, ""

    def keep(text: str) -> None:
        if not silent:
            out.append(text)
        elif silent == "title":
            title.append(text)

    found = _TAG.search(page)
    while found:
        keep(page[at:found.start()])
        at = found.end()
        if found[0] == "<!--":
            end = page.find("-->", at)
            at = len(page) if end < 0 else end + 3
        elif found[2]:
            name, closing = found[2].lower(), bool(found[1])
            if silent:
                silent = "" if closing and name == silent else silent
            elif name in SILENT:
                silent = "" if closing else name
            else:
                if name in BLOCKS:
                    out.append("\n")
                if name == "a" and not closing and (href := _HREF.search(found[3])):
                    links.append(_absolute(base, html.unescape(href[1] or href[2] or href[3] or "")))
        found = _TAG.search(page, at)
    keep(page[at:])
    return _lines("".join(title)).replace("\n", " "), _lines("".join(out)), links


def _absolute(base: str, link: str) -> str:
    try:
        return urljoin(base, link)
    except ValueError:
        return link


def _lines(text: str) -> str:
    lines = (_BLANKS.sub(" ", line).strip() for line in html.unescape(text).replace("\r", "\n").split("\n"))
    return "\n".join(line for line in lines if line)


def responses(pages: DataFrame, page: str = "html", url: str = "url", id_column: str = "page_id",
              date: str = DATE) -> DataFrame:
    """Response records of landed pages: ``page_id, record_id, target_uri, date, block, block_digest, payload_digest``."""
    batches(pages.sparkSession)
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("page"))

    def respond(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for key, uri, text in zip(*(c.to_pylist() for c in batch.columns)):
            payload = (text or "").encode()
            head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            block, sha = head.encode() + payload, digest(payload)
            out.append((record_urn("response", str(key), uri or "", sha), uri, date, block, digest(block), sha))
        kinds = (pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, k) for x, k in zip(zip(*out), kinds))],
            names=["page_id", "record_id", "target_uri", "date", "block", "block_digest", "payload_digest"],
        )

    return map_batches(rows, respond, RESPONSE.format(kind=rows.schema["page_id"].dataType.simpleString()))


def _derived(uri: str | None, source: str, date: str | None, block: bytes | None, block_sha: str | None,
             payload_sha: str | None) -> Iterator[tuple]:
    """The metadata and the conversion record of one response."""
    block = block or b""
    status, fields, payload = http_parts(block)
    title, text, links = page_content(decoded(payload, fields), uri or "")
    ids = {kind: record_urn(source, kind) for kind in ("metadata", "conversion")}
    block_sha, payload_sha = block_sha or digest(block), payload_sha or digest(payload)
    envelope = {
        "source": {"WARC-Type": "response", "WARC-Record-ID": f"<{source}>", "WARC-Target-URI": uri, "WARC-Date": date,
                   "WARC-Block-Digest": block_sha, "WARC-Payload-Digest": payload_sha, "Content-Length": len(block)},
        "http": {"status": status, "headers": [list(field) for field in fields]},
        "html": {"title": title, "links": links},
        "conversion": f"<{ids['conversion']}>",
    }
    made = {
        "metadata": ("application/json", json.dumps(envelope, ensure_ascii=False)),
        "conversion": ("text/plain; charset=utf-8", text),
    }
    for kind, other in (("metadata", "conversion"), ("conversion", "metadata")):
        content_type, content = made[kind]
        data = content.encode("utf-8", "replace")
        sha = digest(data)
        headers = [
            ("WARC-Type", kind), ("WARC-Record-ID", f"<{ids[kind]}>"), ("WARC-Date", date), ("WARC-Target-URI", uri),
            ("WARC-Refers-To", f"<{source}>"), ("WARC-Concurrent-To", f"<{ids[other]}>"),
            ("WARC-Block-Digest", sha), ("WARC-Source-Block-Digest", block_sha),
            ("WARC-Source-Payload-Digest", payload_sha), ("Content-Type", content_type), ("Content-Length", len(data)),
        ]
        lines = [VERSION, *(f"{n}: {' '.join(str(v).split())}" for n, v in headers if v is not None)]
        yield kind, ids[kind], source, uri, "\r\n".join(lines), content_type, data.decode(), sha, payload_sha


def derive(records: DataFrame) -> DataFrame:
    """Two records per response: ``page_id, record_type, record_id, refers_to, target_uri, headers, content_type, block,
    block_digest, payload_digest`` (that of the response)."""
    batches(records.sparkSession)
    names = ["page_id", "target_uri", "record_id", "date", "block", "block_digest", "payload_digest"]
    out_names = ["record_type", "record_id", "refers_to", "target_uri", "headers", "content_type", "block",
                 "block_digest", "payload_digest"]

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [batch.column(n).to_pylist() for n in names[1:]]
        out = [(i, *record) for i, response in enumerate(zip(*columns)) for record in _derived(*response)]
        index, *made = zip(*out)
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id").take(pa.array(index)), *(pa.array(x, pa.string()) for x in made)],
            names=["page_id", *out_names],
        )

    kind = records.schema["page_id"].dataType.simpleString()
    return map_batches(records.select(names), build, RECORD.format(kind=kind))


def write_warc(derived: DataFrame, path: str) -> None:
    """Writes the records as gzipped WARC files, by Spark's text writer (its line end closes each record)."""
    record = F.concat(F.col("headers"), F.lit("\r\n\r\n"), F.col("block"), F.lit("\r\n\r"))
    derived.select(record.alias("value")).write.option("lineSep", "\n").option("compression", "gzip").text(path)
