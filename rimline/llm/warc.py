"""WARC derivatives: for each response record a metadata record and a plain-text conversion record.

Both name the response in WARC-Refers-To, keep its target and date, and carry digests of their own blocks. The
metadata record's block holds the source's headers, its digests and what was found in the page; the
conversion record's block is the page's text. Record ids are made from the response's id, so a repeated job
writes the same records. Blocks are text; ``archived`` gives the records as bytes of a WARC file, and
``parsed`` reads them back.

Defined cases: a page without html has an empty payload; one without a url has an empty target; a row whose id is
null is a page like any other; rows with equal ids have records with ids of their own unless
url and html are the same, too; markup that never ends is dropped to the end; for links and the language a tag
ends at the next angle bracket; an empty table gives no rows; other
columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rimline.llm.common import slices, table

#: The date of records whose pages carry none.
CAPTURED = "2024-01-01T00:00:00Z"
VERSION = "WARC/1.1"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
SOFTWARE = "rimline"

RESPONSE = "page_id long, record_id string, target_uri string, warc_date string, http_headers string, payload string"
DERIVED = (
    "page_id long, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
    "content_length long, block_digest string, refers_to_payload_digest string, source_headers string, block string"
)

#: Elements whose content is no text, comments, and all other markup.
MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(script|style|template|noscript)\b[^>]*>(?:.*?</\1\s*>|.*\Z)|<(/?[a-zA-Z][a-zA-Z0-9]*)[^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
#: Elements that begin and end lines.
BLOCKS = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li "
    "main nav ol p pre section table tbody td tfoot th thead title tr ul".split()
)
SPACES = re.compile(r"[ \t\r\f\v\xa0]+")
# A tag ends at the next bracket of either kind, so tags that never end are each looked at once.
TITLE = re.compile(r"<title\b[^<>]*>([^<]*)", re.IGNORECASE)
ROOT = re.compile(r"<html\b[^<>]*", re.IGNORECASE)
LANGUAGE = re.compile(r"\blang\s*+=\s*+[\"']?([A-Za-z-]+)", re.IGNORECASE)
ANCHOR = re.compile(r"<a\b[^<>]*", re.IGNORECASE)
LINK = re.compile(r"\bhref\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(chr(0).join(parts).encode()).digest()[:16], version=5)}>"


def plain_text(page: str) -> str:
    """The page's text, a line for each block element, without runs of space or empty lines."""

    def between(found: re.Match) -> str:
        name = found.group(2)
        return "\n" if name is not None and name.lstrip("/").lower() in BLOCKS else ""

    text = entities.unescape(MARKUP.sub(between, page))
    lines = (SPACES.sub(" ", line).strip() for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def _fields(pairs: Iterable[tuple[str, str]]) -> str:
    return "".join(f"{name}: {' '.join(value.split())}\r\n" for name, value in pairs)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(ddl))


def responses(pages: DataFrame, captured: str = CAPTURED) -> DataFrame:
    """A response record for each page."""
    schema = _arrow(RESPONSE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for page_id, url, page in zip(part["page_id"], part["url"], part["html"]):
                url = "".join(url.split())
                rows.append((page_id, record_id("response", str(page_id), url, page), url, captured, HTTP.format(len(page.encode())), page))
            yield _batch(rows, schema)

    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), text("url"), text("html")).mapInArrow(run, RESPONSE)


def derive(page_id: int, response: str, target: str, date: str, headers: str, payload: str) -> Iterator[tuple]:
    """The metadata record and the conversion record of a response."""
    body = payload.encode()
    payload_digest = digest(body)
    text = plain_text(payload)
    title = TITLE.search(payload)
    language = next(filter(None, (LANGUAGE.search(tag.group()) for tag in ROOT.finditer(payload))), None)
    hrefs = (LINK.search(tag.group()) for tag in ANCHOR.finditer(payload))
    links = [next(filter(None, href.groups()), "") for href in hrefs if href]
    conversion = record_id("conversion", response)
    about = [
        ("source-record-id", response),
        ("source-block-digest", digest(headers.encode() + body)),
        ("source-payload-digest", payload_digest),
        ("source-payload-length", str(len(body))),
        ("conversion-record-id", conversion),
        ("conversion-digest", digest(text.encode())),
        ("title", entities.unescape(title.group(1)) if title else ""),
        ("language", language.group(1) if language else ""),
        ("via", SOFTWARE),
    ]
    about += [("source-http", line) for line in headers.split("\r\n") if line]
    about += [("outlink", entities.unescape(link)) for link in links]
    for kind, own, content, block in (
        ("metadata", record_id("metadata", response), "application/warc-fields", _fields(about)),
        ("conversion", conversion, "text/plain; charset=utf-8", text),
    ):
        written = block.encode()
        yield page_id, kind, own, response, target, date, content, len(written), digest(written), payload_digest, headers, block


def derivatives(found: DataFrame) -> DataFrame:
    """Two linked records for each response record."""
    schema = _arrow(DERIVED)
    names = [field.name for field in StructType.fromDDL(RESPONSE)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield _batch([row for source in zip(*(part[name] for name in names)) for row in derive(*source)], schema)

    return found.select(names).mapInArrow(run, DERIVED)


def archived(records: DataFrame) -> DataFrame:
    """(page_id, record): each derived record as the bytes that stand for it in a WARC file."""
    head = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "),
        "warc_type",
        *(
            piece
            for name, column in (
                ("WARC-Record-ID", "record_id"),
                ("WARC-Refers-To", "refers_to"),
                ("WARC-Target-URI", "target_uri"),
                ("WARC-Date", "warc_date"),
                ("WARC-Block-Digest", "block_digest"),
                ("Content-Type", "content_type"),
                ("Content-Length", "content_length"),
            )
            for piece in (F.lit(f"\r\n{name}: "), F.col(column).cast("string"))
        ),
        F.lit("\r\n\r\n"),
    )
    return records.select("page_id", F.concat(head, "block", F.lit("\r\n\r\n")).cast("binary").alias("record"))


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """The headers and the block of a record's bytes."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"no {VERSION} record: {version[:40]}")
    headers = dict(line.split(": ", 1) for line in lines)
    return headers, rest[: int(headers["Content-Length"])]


def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives(responses(table(spark, sf_dir, "pages")))
