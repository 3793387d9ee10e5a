"""Derived records of a web archive: metadata and plain text of responses.

Every response gives two records that refer to it: a `metadata` record with a
JSON block (the response's own headers and digests, its HTTP status line and
headers, title, language and links) and a `conversion` record with its plain
text. Both keep the response's identifier (WARC-Refers-To), address, date and
payload digest; the metadata record names the conversion record it was made
with (WARC-Concurrent-To). Identifiers are derived from what a record is made
of, so a repeated run writes the same records.

All of it is per record: nothing is shuffled.

Defined results: a null payload is empty and has empty text; a null address
gives records without WARC-Target-URI; repeated responses give repeated
records of equal identifiers; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from commerce_lake.llm.common import with_text_columns

SOFTWARE = "commerce-lake derivatives"
DATE = "2024-01-01T00:00:00Z"
BREAK = "\r\n"

# Elements that start and end lines, and elements without readable text.
_LINES = frozenset(
    "address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split()
)
# One token a match: a comment, an element without readable text, a tag, a declaration.
# Values in quotes may hold any character; an unclosed quote ends with its tag.
_ATTRIBUTES = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+[^<>]*+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<dark>script|style|noscript|template)\b{_ATTRIBUTES}>.*?(?:</(?P=dark)\s*>|\Z)"
    rf"|<(?P<name>/?[a-zA-Z][a-zA-Z0-9-]*)(?P<attributes>{_ATTRIBUTES})>|<[!?][^<>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+)))?""")
_SPACE = re.compile(r"[^\S\n]+")


def _attribute(attributes: str, wanted: str) -> str | None:
    """Value of the first attribute of a name; None if there is none or it has no value."""
    for found in _ATTRIBUTE.finditer(attributes):
        name, *values = found.groups()
        if name.lower() == wanted:
            return next((html.unescape(v) for v in values if v is not None), None)
    return None


class Page:
    """Readable text, links, title and language of a page, from one pass over its tokens.

    Text has one line per block element and no empty lines. What lies in
    comments and in elements without readable text gives nothing.
    """

    def __init__(self, page: str) -> None:
        self.links: list[str] = []
        self.title: str | None = None
        self.language: str | None = None
        pieces, end, titled = [], 0, False
        for token in _TOKEN.finditer(page):
            between, end = page[end : token.start()], token.end()
            pieces.append(between.replace("\n", " "))
            if titled:
                self.title, titled = html.unescape(between).strip(), False
            name = (token["name"] or "").lower()
            if token["dark"]:
                pieces.append(" ")
            elif name.strip("/") in _LINES:
                pieces.append("\n")
            if name == "a" and (href := _attribute(token["attributes"], "href")) is not None:
                self.links.append(href)
            elif name == "title" and self.title is None:
                titled = True
            elif name == "html" and self.language is None:
                found = re.match(r"\s*([A-Za-z-]+)", _attribute(token["attributes"], "lang") or "")
                self.language = found[1].lower() if found else None
        pieces.append(page[end:].replace("\n", " "))
        if titled:
            self.title = html.unescape(page[end:]).strip()
        lines = (_SPACE.sub(" ", line).strip() for line in html.unescape("".join(pieces)).split("\n"))
        self.text = "\n".join(line for line in lines if line)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def identifier(*parts: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(chr(0).join(parts).encode()).digest()[:16], version=4)}>"


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of a table (page_id, url, html): record_id, target_uri,
    date, http (status line and headers) and payload."""
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
        F.octet_length(F.coalesce("html", F.lit(""))).cast("string"), F.lit(BREAK * 2),
    )
    key = F.sha2(F.concat_ws("\0", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))), 256)
    parts = [F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return pages.select(
        "page_id", F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"), head.alias("http"), F.col("html").alias("payload"),
    )


def _headers(http: str) -> tuple[str, dict[str, str]]:
    status, *lines = http.strip().split(BREAK)
    return status, dict(line.split(": ", 1) for line in lines if ": " in line)


def record(headers: dict[str, str], block: bytes) -> str:
    """A whole record but for the two line breaks that end it."""
    head = {**headers, "WARC-Block-Digest": digest(block), "Content-Length": str(len(block))}
    return f"WARC/1.1{BREAK}" + "".join(f"{k}: {v}{BREAK}" for k, v in head.items()) + BREAK + block.decode()


def derive_one(record_id: str, target: str, date: str, http: str, page: str) -> list[tuple]:
    payload = page.encode()
    block, source = digest(http.encode() + payload), digest(payload)
    kinds = {kind: identifier(kind, record_id) for kind in ("metadata", "conversion")}
    read = Page(page)
    status, headers = _headers(http)
    described = {
        "source": {
            "WARC-Type": "response", "WARC-Record-ID": record_id, "WARC-Target-URI": target, "WARC-Date": date,
            "WARC-Block-Digest": block, "WARC-Payload-Digest": source, "Content-Length": len(http.encode()) + len(payload),
        },
        "http": {"status": status, "headers": headers},
        "html": {
            "title": read.title, "language": read.language, "links": read.links,
        },
        "text": {"WARC-Record-ID": kinds["conversion"], "characters": len(read.text)},
    }
    out = []
    for kind, content, body in (
        ("metadata", "application/json", json.dumps(described, ensure_ascii=False).encode()),
        ("conversion", "text/plain; charset=utf-8", read.text.encode()),
    ):
        header = {"WARC-Type": kind, "WARC-Record-ID": kinds[kind], "WARC-Refers-To": record_id}
        if kind == "metadata":
            header["WARC-Concurrent-To"] = kinds["conversion"]
        if target:
            header["WARC-Target-URI"] = target
        header |= {"WARC-Date": date, "WARC-Payload-Digest": digest(body), "X-Source-Payload-Digest": source, "Content-Type": content}
        out.append({
            "kind": kind, "record_id": kinds[kind], "refers_to": record_id, "concurrent_to": header.get("WARC-Concurrent-To"),
            "source_digest": source, "block_digest": digest(body), "content_length": len(body), "n_links": len(read.links),
            "record": record(header, body),
        })
    return out


RECORDS = (
    "array<struct<kind:string,record_id:string,refers_to:string,concurrent_to:string,source_digest:string,"
    "block_digest:string,content_length:long,n_links:long,record:string>>"
)


def derive(source: DataFrame) -> DataFrame:
    """Two rows per response record (record_id, target_uri, date, http, payload),
    with all other columns of it; `record` is the record as it is written."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    packed = F.to_json(F.struct(*[text(c).alias(c) for c in ("record_id", "target_uri", "date", "http", "payload")]))

    def make():
        def work(texts: list[str]) -> list[list]:
            return [[derive_one(*json.loads(t).values()) for t in texts]]

        return work

    taken = {"record_id", "http", "payload", *StructType.fromDDL(f"r {RECORDS}")["r"].dataType.elementType.names}
    rest = [c for c in source.columns if c.lower() not in taken]
    rows = with_text_columns(source.select(*rest, packed.alias("_packed")), "_packed", make, f"_records {RECORDS}", drop_text=True)
    return rows.select(*rest, F.explode("_records").alias("_record")).select(*rest, "_record.*")


def write(records: DataFrame, path: str) -> None:
    """Compressed files of whole records, one or more per task."""
    records.select("record").write.option("lineSep", BREAK * 2).option("compression", "gzip").text(path)
