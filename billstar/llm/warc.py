"""WARC derivatives: response records become linked metadata and
plain-text conversion records.

Archive files are written by Spark's text source and read by one task
each, record by record, by the length that each record states; records are rows
with their header fields as a map. A derived record refers to its response by record id,
keeps the target URI and date, and carries digests of its own block; the
metadata record lists the source's headers and digests. The page's text
is the conversion record's block.
"""

from __future__ import annotations

import gzip
import io
import re
import zlib
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1
from html import unescape
from typing import BinaryIO
from uuid import NAMESPACE_URL, uuid5

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billstar.sources import fs

VERSION = "WARC/1.0"
EOL = "\r\n"
#: Octets of the longest record that fits a row, of the longest header line, and of the rows handed on together.
LARGEST, LINE, BATCH = 1 << 30, 1 << 20, 16 << 20
_NEXT = re.compile(rb"\r\n\r\n(?=WARC/1\.[01]\r\n)")
RECORD = "record_id string, record_type string, headers map<string,string>, block string"

_DROP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(
    r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr"
    r"|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^<>]*>", re.I)
_TAG = re.compile(r"<[!/?a-zA-Z][^>]*>?")


def digest(block: str) -> str:
    return "sha1:" + b32encode(sha1(block.encode("utf-8", "replace")).digest()).decode()


def plain_text(html: str | None) -> str:
    """The text of a page: without comments, scripts and styles, a line
    per block element, entities resolved, blank runs and lines collapsed."""
    text = _DROP.sub(" ", html or "")
    text = unescape(_TAG.sub("", _BREAK.sub("\n", text)))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def urn(*parts: str) -> str:
    return f"<urn:uuid:{uuid5(NAMESPACE_URL, ' '.join(parts))}>"


def http_parts(block: str) -> tuple[str, dict[str, str], str]:
    """Status line, header fields and payload of an HTTP response block;
    a block without a blank line is all header."""
    head, _, payload = block.partition(EOL * 2)
    status, *lines = head.split(EOL)
    fields = {}
    for line in lines:
        name, _, value = line.partition(":")
        fields.setdefault(name.strip(), value.strip())
    return status, fields, payload


def responses(pages: DataFrame, date: str, id_col: str = "page_id") -> DataFrame:
    """(id, record_id, record_type, headers, block): pages as WARC response
    records. Ids derive from page id, url and payload, so reruns agree and
    only equal pages share one; a NULL url gives no target URI, a NULL page
    an empty payload."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, url, html in zip(pdf.key, pdf.url, pdf.html):
                payload = html or ""
                size = len(payload.encode("utf-8", "replace"))
                block = EOL.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8",
                                  f"Content-Length: {size}", "", payload])
                headers = {
                    "WARC-Record-ID": urn("response", repr(key), repr(url), digest(payload)),
                    "WARC-Type": "response",
                    "WARC-Date": date, "Content-Type": "application/http; msgtype=response",
                    "WARC-Payload-Digest": digest(payload), "WARC-Block-Digest": digest(block),
                    "Content-Length": str(len(block.encode("utf-8", "replace"))),
                }
                if url is not None:
                    headers["WARC-Target-URI"] = url
                rows.append((key, headers["WARC-Record-ID"], "response", headers, block))
            yield pd.DataFrame(rows, columns=["key", "record_id", "record_type", "headers", "block"])

    rows = pages.select(F.col(id_col).cast("string").alias("key"), "url", "html")
    kind = pages.schema[id_col].dataType.simpleString()
    return rows.mapInPandas(build, "key string, " + RECORD).select(
        F.col("key").cast(kind).alias(id_col), "record_id", "record_type", "headers", "block")


def derive(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Two records, metadata and conversion, for each response record; other types,
    NULL ids and records that :func:`read` found damaged (see :func:`damaged`)
    give none. ``keep`` names columns carried along.

    The metadata block lists the source's HTTP status and header fields,
    and its payload and block digests: those it states and, under
    ``computed-``, those of the bytes at hand, so that a damaged record shows.
    """
    keep = keep or []
    kept = ", ".join(f"{c} {records.schema[c].dataType.simpleString()}" for c in keep)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for rid, headers, block, *extra in zip(pdf.record_id, pdf.headers, pdf.block, *(pdf[c] for c in keep)):
                source = dict(headers or {})
                block = block or ""
                status, fields, payload = http_parts(block)
                said = [("http-status", status), *((f"http-{k.lower()}", v) for k, v in fields.items())]
                said += [(f"source-{k.lower()}", source[f"WARC-{k}"])
                         for k in ("Payload-Digest", "Block-Digest") if f"WARC-{k}" in source]
                said += [("computed-payload-digest", digest(payload)), ("computed-block-digest", digest(block))]
                made = (
                    ("metadata", "application/warc-fields", "".join(f"{k}: {v}{EOL}" for k, v in said)),
                    ("conversion", "text/plain; charset=utf-8", plain_text(payload)),
                )
                for kind, media, text in made:
                    own = {
                        "WARC-Record-ID": urn(kind, rid), "WARC-Type": kind, "WARC-Refers-To": rid,
                        "Content-Type": media, "WARC-Block-Digest": digest(text),
                        "Content-Length": str(len(text.encode("utf-8", "replace"))),
                    }
                    own |= {k: source[k] for k in ("WARC-Date", "WARC-Target-URI") if k in source}
                    rows.append((*extra, own["WARC-Record-ID"], kind, own, text))
            yield pd.DataFrame(rows, columns=[*keep, "record_id", "record_type", "headers", "block"])

    wanted = records.where("record_type = 'response' and record_id is not null")
    if "intact" in records.columns:
        wanted = wanted.where("intact")
    return wanted.select("record_id", "headers", "block", *keep).mapInPandas(
        build, f"{kept}, {RECORD}" if kept else RECORD)


def serialised() -> Column:
    """A record row as the text between two separators: header lines, a
    blank line and the block. The version line is the separator's."""
    lines = F.transform(
        F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return F.concat(F.array_join(lines, EOL), F.lit(EOL * 2), F.coalesce("block", F.lit("")))


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as WARC files, one per partition. Each file opens
    with the version line and ends its last record with two line ends.
    Header fields must not hold line ends."""
    text = F.concat(F.lit(VERSION + EOL), serialised())
    records.select(text.alias("value")).write.option("lineSep", EOL * 2).option(
        "compression", compression).text(path)


class _Octets:
    """A stream that takes octets back. A damaged gzip member ends it."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.back = stream, io.BytesIO()

    def _take(self, n: int, ask: str) -> bytes:
        out = getattr(self.back, ask)(n)
        if len(out) < n and not (ask == "readline" and out.endswith(b"\n")):
            try:
                out += getattr(self.stream, ask)(n - len(out))
            except (EOFError, zlib.error, gzip.BadGzipFile):
                pass
        return out

    def read(self, n: int) -> bytes:
        return self._take(n, "read")

    def line(self) -> bytes:
        return self._take(LINE, "readline")

    def give_back(self, octets: bytes) -> None:
        self.back = io.BytesIO(octets + self.back.read())


def records_of(stream: BinaryIO, largest: int = LARGEST) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """(headers, block, fault) of the records of an uncompressed archive.

    A block has the octets that Content-Length states, whatever they hold. What is
    not so is told by its fault: ``no length``, ``too long`` (over
    ``largest``), ``cut off`` (the file ends first) or ``wrong length`` (no
    two line ends follow). Reading goes on at the next version line, also
    where that lies within a block that states too much.
    """
    src = _Octets(stream)
    while line := src.line():
        if not line.startswith(b"WARC/1."):
            continue  # line ends between records, or what a damaged one left
        headers, name = {}, None
        while (line := src.line()).strip():
            text = line.decode("utf-8", "replace")
            if text[0] in " \t" and name:
                headers[name] += " " + text.strip()
                continue
            key, _, value = text.partition(":")
            name = key.strip()
            headers.setdefault(name, value.strip())
        length = next((v for k, v in headers.items() if k.lower() == "content-length"), "")
        if not re.fullmatch("[0-9]{1,18}", length):
            yield headers, b"", "no length"
            continue
        if int(length) > largest:
            yield headers, b"", "too long"
            continue
        block, fault = src.read(int(length)), None
        if len(block) < int(length):
            fault = "cut off"
        else:
            after = src.read(4)
            if not b"\r\n\r\n".startswith(after):
                fault = "wrong length"
                src.give_back(after)
        if fault and (found := _NEXT.search(block)):
            src.give_back(block[found.end():])
            block, fault = block[:found.start()], "wrong length"
        yield headers, block, fault


def _archive(path: str) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    store, p = fs.arrow_fs(path)
    with store.open_input_stream(p, compression=None) as f:
        plain = io.BufferedReader(f, 1 << 20)
        packed = plain.peek(2)[:2] == b"\x1f\x8b"
        yield from records_of(gzip.GzipFile(fileobj=plain) if packed else plain)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, headers, block, intact, fault) of WARC 1.0
    and 1.1 files, plain or gzip, as UTF-8. ``intact`` records have no
    ``fault``, see :func:`records_of`. Each file is read by one task, which
    holds one batch of records at a time; an empty folder gives no row."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["record_id", "record_type", "headers", "block", "intact", "fault"]
        rows, size = [], 0
        for pdf in batches:
            for file in pdf.path:
                for headers, block, fault in _archive(file):
                    known = {k.lower(): v for k, v in headers.items()}
                    rows.append((known.get("warc-record-id"), known.get("warc-type"), headers,
                                 block.decode("utf-8", "replace"), fault is None, fault))
                    size += len(block) + 1000
                    if size >= BATCH:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, size = [], 0
        yield pd.DataFrame(rows, columns=columns)

    files = spark.read.format("binaryFile").load(path).select("path")
    return files.repartitionByRange(max(1, files.count()), "path").mapInPandas(
        parse, RECORD + ", intact boolean, fault string")


def damaged(records: DataFrame) -> DataFrame:
    """(record_id, record_type, fault) of the records that :func:`derive` leaves out."""
    return records.where("not intact").select("record_id", "record_type", "fault")
