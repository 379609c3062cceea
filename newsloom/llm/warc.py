"""WARC derivatives: from response records to linked metadata and plain-text conversions.

Each response gives two records that name it in ``WARC-Refers-To`` and carry its target and
date: a ``metadata`` record, a JSON envelope with the response's own WARC headers, digests,
HTTP status and headers, title, description and links, and a ``conversion`` record with the
page's text. Record ids are made from the response's id, so a repeated run gives the same
ones; block digests are those of the new blocks, the payload digest of the response is kept
and compared with its payload.

All work is per record, in the task that reads it: no row moves. ``write`` puts records into
WARC files with a text sink, whose line end is the end of a record, so it works on any store.

Nulls: a null URL leaves ``WARC-Target-URI`` out, a null page has an empty payload, a null id
stays null. Empty payloads give empty texts. Rows that repeat give the same records again.
Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DATE = "2024-01-01T00:00:00Z"
VERSION = "WARC/1.1"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122

RESPONSE = (
    "page_id bigint, record_id string, target_uri string, date string, "
    "payload_digest string, headers array<struct<name:string, value:string>>, block binary"
)
RECORD = (
    "page_id bigint, record_type string, record_id string, refers_to string, "
    "target_uri string, date string, content_type string, content_length bigint, "
    "block_digest string, payload_digest string, digest_valid boolean, headers string, block string"
)
_HEADERS = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))

BLOCKS = frozenset(
    "address article aside blockquote body br center dd div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section "
    "table tbody td tfoot th thead title tr ul".split()
)
HIDDEN = frozenset(("script", "style", "template", "noscript"))
LINKS = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src",
         "iframe": "src", "source": "src", "form": "action"}


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, chr(0).join(parts))}>"


def _plain(value: str) -> str:
    """A header value stays on its line."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value)


class Page(HTMLParser):
    """Title, description, links and text of a page."""

    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.title, self.description = base, [], ""
        origin = re.match(r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?=/|\Z)", base)
        self.origin = origin.group() if origin else ""
        self.links: list[dict[str, str]] = []
        self.lines: list[list[str]] = [[]]
        self.hidden = 0
        self.in_title = False

    def updatepos(self, i: int, j: int) -> int:
        """Nobody asks for line numbers."""
        return j

    def resolve(self, target: str) -> str:
        """Absolute paths without dot segments, the most common, need no general rule."""
        if self.origin and target[:1] == "/" and target[1:2] != "/" and "/." not in target:
            return self.origin + target
        try:
            return urljoin(self.base, target)
        except ValueError:  # an address that cannot be resolved stays as written
            return target

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = dict(attrs)
        if target := given.get(LINKS.get(tag, "")):
            self.links.append({"path": f"{tag}@{LINKS[tag]}", "url": self.resolve(target)})
        if tag == "meta" and (given.get("name") or "").lower() == "description":
            self.description = given.get("content") or ""
        self.in_title = self.in_title or tag == "title"
        self.hidden += tag in HIDDEN
        if tag in BLOCKS and self.lines[-1]:
            self.lines.append([])

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == "title":
            self.in_title = False
        if tag in HIDDEN and self.hidden:
            self.hidden -= 1
        if tag in BLOCKS and self.lines[-1]:
            self.lines.append([])

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.title.append(data)
        if not self.hidden:
            self.lines[-1].append(data)

    def text(self) -> str:
        rows = (" ".join("".join(line).split()) for line in self.lines)
        return "\n".join(row for row in rows if row)


def read_page(markup: str, base: str) -> Page:
    page = Page(base)
    page.feed(markup)
    page.close()
    return page


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP response."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        head, payload = b"", block
    status, *rest = head.decode("latin-1").split("\r\n")
    pairs = [line.partition(":") for line in rest if ":" in line]
    return status, [(k.strip(), v.strip()) for k, _, v in pairs], payload


def named_values(pairs: list[tuple[str, str]]) -> dict[str, str | list[str]]:
    """Headers by name; one that is repeated has the list of its values, in order."""
    found: dict[str, list[str]] = {}
    for name, value in pairs:
        found.setdefault(name, []).append(value)
    return {name: values[0] if len(values) == 1 else values for name, values in found.items()}


def decode(payload: bytes, http: list[tuple[str, str]]) -> str:
    """The payload by the charset of its first Content-Type, by UTF-8 without a known one."""
    types = [value for name, value in http if name.lower() == "content-type"]
    given = re.search(r"charset\s*=\s*[\"']?([A-Za-z0-9._:-]+)", types[0], re.I) if types else None
    try:
        return payload.decode(given.group(1) if given else "utf-8", "replace")
    except (LookupError, ValueError):  # not the name of a text encoding, or one that fails
        return payload.decode("utf-8", "replace")


def _respond(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for page, url, html in zip(
                    part["page_id"].to_pylist(), part["url"], part["html"], strict=True
                ):
                    target = url.as_py()
                    payload = (html.as_py() or "").encode("utf-8", "replace")
                    block = (
                        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                        + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
                    )
                    whole, inner = digest(block), digest(payload)
                    own = record_id("response", str(page), target or "", whole)
                    named = [
                        ("WARC-Type", "response"), ("WARC-Record-ID", own), ("WARC-Date", date),
                        ("Content-Type", "application/http; msgtype=response"),
                        ("Content-Length", str(len(block))),
                        ("WARC-Block-Digest", whole),
                        ("WARC-Payload-Digest", inner),
                    ]
                    if target is not None:
                        named.append(("WARC-Target-URI", _plain(target)))
                    rows.append((
                        page, own, target, date, inner,
                        [{"name": k, "value": v} for k, v in named], block,
                    ))
                types = [pa.int64(), *[pa.string()] * 4, _HEADERS, pa.binary()]
                names = ["page_id", "record_id", "target_uri", "date", "payload_digest",
                         "headers", "block"]
                yield _batch(rows, types, names)

    return run


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
    )


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of fetched pages (``page_id, url, html``)."""
    return pages.select("page_id", "url", "html").mapInArrow(_respond(date), RESPONSE)


def derive(row: dict) -> list[tuple]:
    """The metadata and the conversion record of a response."""
    source, target, date = row["record_id"], row["target_uri"], row["date"]
    status, http, payload = split_http(row["block"] or b"")
    found = digest(payload)
    given = row["payload_digest"]
    page = read_page(decode(payload, http), target or "")
    envelope = {
        "warc": named_values([(h["name"], h["value"]) for h in row["headers"] or []]),
        "http": {"status": status, "headers": named_values(http)},
        "payload": {"length": len(payload), "digest": found, "valid": given in (None, found)},
        "html": {
            "title": " ".join("".join(page.title).split()), "description": page.description,
            "links": page.links,
        },
    }
    out = []
    for kind, content, block in (
        ("metadata", "application/json", json.dumps(envelope, ensure_ascii=False, sort_keys=True)),
        ("conversion", "text/plain; charset=utf-8", page.text()),
    ):
        data = block.encode("utf-8", "replace")
        block, whole = data.decode(), digest(data)
        own = record_id(kind, source)
        named = [
            ("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", source),
            ("WARC-Date", date), ("Content-Type", content), ("Content-Length", str(len(data))),
            ("WARC-Block-Digest", whole),
        ]
        if target is not None:
            named.append(("WARC-Target-URI", _plain(target)))
        if kind == "conversion" and given is not None:
            named.append(("WARC-Source-Payload-Digest", given))
        headers = "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in named)])
        out.append((
            row["page_id"], kind, own, source, target, date, content, len(data), whole,
            given, given in (None, found), headers, block,
        ))
    return out


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.strip().split(" ")[0] for c in RECORD.split(",")]
    types = [
        pa.int64(), *[pa.string()] * 6, pa.int64(), *[pa.string()] * 2, pa.bool_(),
        *[pa.string()] * 2,
    ]
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = [r for row in batch.slice(at, 256).to_pylist() for r in derive(row)]
            yield _batch(rows, types, names)


def derivatives(records: DataFrame) -> DataFrame:
    """Two records per response of ``records`` (the columns of ``RESPONSE``)."""
    names = ["page_id", "record_id", "target_uri", "date", "payload_digest", "headers", "block"]
    return records.select(*names).mapInArrow(_derive, RECORD)


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write derivative records as WARC files: a record ends with two line ends."""
    whole = F.concat("headers", F.lit("\r\n\r\n"), "block")
    records.select(whole.alias("value")).write.option("lineSep", "\r\n\r\n").option(
        "compression", compression
    ).text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an uncompressed WARC file."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:stop].decode().split("\r\n")
        if version != VERSION:
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        start = stop + 4
        size = int(headers["Content-Length"])
        yield headers, data[start : start + size]
        at = start + size + 4
