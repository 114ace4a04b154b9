"""WARC derivatives: each response becomes a metadata record and a plain-text conversion record.

Records are rows: type, id, date, target URI, the record it refers to, the record it is concurrent to, content type, block,
block digest, payload digest and length. `responses` makes response records from a table of fetched pages, `derive` the
linked records, `encode` the bytes of WARC/1.1 records, `decode` reads such bytes back. Ids are name-based, so a rerun
or a lost executor gives the same ids; repeated rows give repeated records.

The conversion is the page's visible text: scripts, styles, comments and markup go, block elements end lines, character
references are resolved, runs of blanks become one. It keeps the response's URI, date and digest and refers to its id.
The metadata record holds the response's HTTP headers, the title, the language, outgoing links, and the id of the conversion.
A null page is an empty payload; a null URL is an empty target. Bytes that are not UTF-8 are replaced. Keys of any type are kept; other
columns are not looked at. A page is held whole by its task and read in time proportional to its length.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

FIELDS = ("record_type", "record_id", "date", "target_uri", "refers_to", "concurrent_to", "refers_to_date", "content_type", "block", "block_digest", "payload_digest", "content_length")
_REST = [T.StructField(f, T.BinaryType() if f == "block" else T.LongType() if f == "content_length" else T.StringType()) for f in FIELDS]
#: Header names of the standard, by field.
_HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "date": "WARC-Date", "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To",
    "concurrent_to": "WARC-Concurrent-To", "refers_to_date": "WARC-Refers-To-Date", "content_type": "Content-Type", "block_digest": "WARC-Block-Digest",
    "payload_digest": "WARC-Payload-Digest", "content_length": "Content-Length",
}

_OPEN = re.compile(r"<[a-zA-Z/!?]")
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9]*)")
_HIDES = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template")}
_BREAKS = frozenset("p div br li ul ol h1 h2 h3 h4 h5 h6 tr table section article header footer nav main aside blockquote pre title hr form option".split())
_BLANK, _LINES = re.compile(r"[^\S\n]+"), re.compile(r" ?\n[ \n]*")
_TITLE_END = re.compile(r"</title\s*>", re.I)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)
_HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


@dataclass
class Page:
    """What a page says: its visible text, title, language and links."""

    text: str
    title: str | None = None
    lang: str | None = None
    links: list[str] = field(default_factory=list)


def parsed(page: str) -> Page:
    """Reads a page in one scan from left to right.

    Every search goes forward from where the last one ended, and what is not found once is not looked for again, so that unclosed comments, tags and
    scripts cost no more than the page's length. An unclosed comment or script hides nothing but its own tag; text behind a tag that never ends is text.
    """
    out, found, at, never = [], Page(""), 0, set()
    while opening := _OPEN.search(page, at):
        begin = opening.start()
        out.append(page[at:begin])
        if page.startswith("<!--", begin) and "-->" not in never:
            if (end := page.find("-->", begin + 4)) >= 0:
                out.append(" ")
                at = end + 3
                continue
            never.add("-->")
        end = page.find(">", begin + 2)
        if end < 0:
            at = begin
            break
        at, tag = end + 1, page[begin : end + 1]
        match = _NAME.match(tag)
        name = match[1].lower() if match else ""
        is_start = not tag.startswith("</")
        out.append("\n" if name in _BREAKS else " ")
        if is_start and name in _HIDES and name not in never:
            if close := _HIDES[name].search(page, at):
                at = close.end()
            else:
                never.add(name)
        elif is_start and name == "title" and found.title is None and name not in never:
            if close := _TITLE_END.search(page, at):
                found.title = " ".join(html.unescape(page[at : close.start()]).split())
            else:
                never.add(name)
        elif is_start and name == "html" and found.lang is None and (lang := _LANG.search(tag)):
            found.lang = lang[1]
        elif is_start and name == "a" and (link := _HREF.search(tag)):
            found.links.append(" ".join(html.unescape(next(filter(None, link.groups()), "")).split()))
    out.append(page[at:])
    found.text = _LINES.sub("\n", _BLANK.sub(" ", html.unescape("".join(out)).replace("\r", "\n"))).strip()
    return found


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def _schema(key: T.StructField) -> T.StructType:
    return T.StructType([T.StructField("key", key.dataType), *_REST])


def _batches(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _record(key: object, kind: str, identity: str, block: bytes, **more: object) -> dict:
    return {"key": key, "record_type": kind, "record_id": identity, "block": block, "block_digest": digest(block), "content_length": len(block), **more}


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """A response record per page: an HTTP header block and the page as payload. The key keeps its type."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("page"))
    schema = _schema(rows.schema["key"])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                out = []
                for row in batch.slice(begin, 256).to_pylist():
                    payload, uri = (row["page"] or "").encode(), row["url"] or ""
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                    out.append(
                        _record(
                            row["key"], "response", record_id("response", row["key"], uri, digest(payload)), head + payload, date=date, target_uri=uri,
                            content_type="application/http; msgtype=response", payload_digest=digest(payload),
                        )
                    )
                yield _batches(out, arrow)

    return rows.mapInArrow(run, schema)


def derive(records: DataFrame) -> DataFrame:
    """A conversion and a metadata record for every response among the records."""
    rows = records.filter(F.col("record_type") == "response").select("key", *FIELDS)
    schema = _schema(rows.schema["key"])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                out = []
                for row in batch.slice(begin, 256).to_pylist():
                    head, _, payload = (row["block"] or b"").partition(b"\r\n\r\n")
                    page = parsed(payload.decode("utf-8", "replace"))
                    text = page.text.encode()
                    source, shared = row["record_id"], {"date": row["date"], "target_uri": row["target_uri"], "refers_to": row["record_id"], "refers_to_date": row["date"]}
                    conversion = record_id("conversion", source)
                    out.append(_record(row["key"], "conversion", conversion, text, content_type="text/plain", payload_digest=digest(text), **shared))
                    lines = [f"source-{n.strip().lower()}: {v.strip()}" for n, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])]
                    lines += [f"source-payload-digest: {row['payload_digest']}", f"source-block-digest: {row['block_digest']}", f"conversion: {conversion}"]
                    lines += [f"title: {page.title}"] if page.title is not None else []
                    lines += [f"language: {page.lang}"] if page.lang else []
                    lines += [f"outlink: {link}" for link in page.links]
                    block = "".join(f"{x}\r\n" for x in lines).encode()
                    out.append(_record(row["key"], "metadata", record_id("metadata", source), block, content_type="application/warc-fields", concurrent_to=conversion, **shared))
                yield _batches(out, arrow)

    return rows.mapInArrow(run, schema)


def encode(records: DataFrame) -> DataFrame:
    """Adds `warc`: the record as bytes."""
    lines = [F.when(F.col(f).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(f).cast("string"), F.lit("\r\n"))).otherwise("") for f, name in _HEADERS.items()]
    head = F.concat(F.lit("WARC/1.1\r\n"), *lines, F.lit("\r\n"))
    return records.withColumn("warc", F.concat(head.cast("binary"), F.coalesce("block", F.lit(b"")), F.lit(b"\r\n\r\n")))


def decode(files: DataFrame, content: str = "content") -> DataFrame:
    """The records in a column of WARC bytes, such as files read with `binaryFile`; gzip members, one or many per value, are unpacked.

    A record that breaks off at the end of its bytes is left out.
    """
    fields = {name.lower(): f for f, name in _HEADERS.items()}
    schema = _schema(T.StructField("key", T.LongType()))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                data, at, out = value.as_py() or b"", 0, []
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                while (end := data.find(b"\r\n\r\n", at)) >= 0:
                    pairs = (line.partition(":") for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:])
                    row = {fields[n.strip().lower()]: v.strip() for n, _, v in pairs if n.strip().lower() in fields}
                    size = int(row.get("content_length", 0))
                    row |= {"key": None, "content_length": size, "block": data[end + 4 : end + 4 + size]}
                    at = end + 8 + size
                    if len(row["block"]) == size:
                        out.append(row)
                    if len(out) == 256:
                        yield _batches(out, arrow)
                        out = []
                yield _batches(out, arrow)

    return files.select(F.col(content)).mapInArrow(run, schema)
